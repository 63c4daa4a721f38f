"""Put the company of a branch on its movements, from a slowly changing lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.time import at
from tallyline.session import materialize
from tallyline.sources.lookup import Lookup

SNAPSHOT_HOURS = 10


def join_lookup(rows: DataFrame, lookup: Lookup, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join with a lookup: replicated if its measured size allows, else a sort-merge join through a shuffle.

    The rows of a heavy key are parted by the adaptive skew join, by the tasks they come from, so equal rows part as well. Where a row goes is
    decided by its key alone, hence a task that is run again sends its rows to where they went before.
    """
    if lookup.fits_broadcast:
        return rows.join(F.broadcast(lookup.rows), on, how)
    return rows.hint("merge").join(lookup.rows, on, how)


def unassigned(movements: DataFrame) -> DataFrame:
    """Movements whose company is still empty; the others are not looked up."""
    return movements.where(F.length("company") == 0)


def assigned(movements: DataFrame) -> DataFrame:
    """Movements that came with a company."""
    return movements.where(F.length("company") > 0)


def enrich(movements: DataFrame, lookup: Lookup, keep_assigned: bool = False) -> DataFrame:
    """Replace the empty company by the looked-up one; a branch the lookup does not know is dropped.

    A movement that already has a company is dropped as well, unless ``keep_assigned``.
    """
    found = join_lookup(unassigned(movements).drop("company"), lookup, ["branch"])
    found = found.select(*movements.columns)
    return found.unionByName(assigned(movements)) if keep_assigned else found


def branch_misses(movements: DataFrame, lookup: Lookup) -> DataFrame:
    """Number of movements for each branch the lookup does not know, counted before the join."""
    per_branch = unassigned(movements).groupBy("branch").agg(F.count("*").alias("n"))
    return join_lookup(per_branch, lookup, ["branch"], "left_anti")


def lookup_misses(movements: DataFrame, lookup: Lookup) -> DataFrame:
    """Movements whose branch the lookup does not know."""
    return join_lookup(unassigned(movements).drop("company"), lookup, ["branch"], "left_anti")


def snapshot_window(ts: Column | str) -> Column:
    """Start of the epoch-aligned ten-hour window that holds ``ts``."""
    return F.window(ts, f"{SNAPSHOT_HOURS} hours")["start"]


def snapshot_as_of(wanted: DataFrame, snapshots: DataFrame) -> DataFrame:
    """For each distinct ``branch, window`` that is asked for, the company of the branch's newest snapshot at or before it.

    One as-of merge: both sides in one column of windows per branch, and the last company that is not null. A branch has at most two rows
    per ten hours, 1,754 a year, whatever its number of movements.
    """
    asked = wanted.select("branch", "window").distinct().withColumn("company", F.lit(None).cast("string"))
    sides = asked.withColumn("asked", F.lit(True)).unionByName(
        snapshots.select("branch", "window", "company").withColumn("asked", F.lit(False))
    )
    upto = Window.partitionBy("branch").orderBy("window").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = sides.withColumn("company", F.last("company", ignorenulls=True).over(upto))
    return found.where("asked AND company IS NOT NULL").select("branch", "window", "company")


def enrich_as_of(movements: DataFrame, snapshots: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Look the company up in the newest snapshot of the movement's own branch at or before its window, each branch for itself.

    Snapshots are rows ``branch, window, company``, unique per branch and window; those without a company are left out.
    """
    rows = unassigned(movements).drop("company").withColumn("window", snapshot_window(ts))
    resolved = Lookup.measure(materialize(snapshot_as_of(rows, snapshots), "as-of"), keys=["branch", "window"])
    return join_lookup(rows, resolved, ["branch", "window"]).select(*movements.columns)


def _covered_windows(snapshots: DataFrame) -> DataFrame:
    """Each window between the first and the last snapshot, with the newest snapshot at or before it.

    There is one row per ten hours of calendar, 877 a year however many branches or movements there are,
    which is why one ordered window may hold all snapshot times.
    """
    step = F.make_dt_interval(hours=F.lit(SNAPSHOT_HOURS))
    following = F.lead("snapshot").over(Window.orderBy("snapshot"))
    return (
        snapshots.select(F.col("window").alias("snapshot"))
        .distinct()
        .withColumn("following", following)
        .where(F.col("following").isNotNull())
        .select("snapshot", F.explode(F.sequence("snapshot", F.col("following") - step, step)).alias("window"))
    )


def enrich_from_snapshot(
    movements: DataFrame, snapshots: Lookup, ts: str = "timestamp", previous: bool = False
) -> DataFrame:
    """Look the company up in the snapshot ``branch, window, company`` of the movement's own window.

    With ``previous``, a window without any snapshot uses the newest one before it.
    """
    rows = unassigned(movements).drop("company").withColumn("window", snapshot_window(ts))
    if previous:
        newest = snapshots.rows.agg(F.max("window")).first()[0]
        if newest is None:
            return movements.limit(0)
        covered = Lookup.measure(_covered_windows(snapshots.rows), keys=["window"])
        after_last = F.when(F.col("window") >= at(newest), at(newest))
        rows = (
            join_lookup(rows, covered, ["window"], "left")
            .withColumn("window", F.coalesce("snapshot", after_last))
            .drop("snapshot")
        )
    return join_lookup(rows, snapshots, ["branch", "window"]).select(*movements.columns)
