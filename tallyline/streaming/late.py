"""Visits per minute with late events as an output of their own, instead of dropping them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.time import NTZ, at, minute_floor
from tallyline.sources.store import Family, PartialStore


def _merge_marks(marks: DataFrame) -> DataFrame:
    return marks.agg(F.max("newest").alias("newest"))


def _merge_visits(partials: DataFrame) -> DataFrame:
    return partials.groupBy("minute").agg(F.sum("visits").alias("visits"))


VISITS = "minute TIMESTAMP_NTZ, visits BIGINT"
LATE_FAMILIES = {
    "on_time": Family(VISITS, _merge_visits, "minute"),
    "late": Family(VISITS, _merge_visits, "minute"),
    "marks": Family("newest TIMESTAMP_NTZ", _merge_marks),
}


def late_batch(store: PartialStore, run: str, delay: timedelta, compact_every: int) -> Callable[[DataFrame, int], None]:
    """Count a batch's visits on time and late.

    An event is late if its minute had ended ``delay`` or more before the newest event of the batches before its own. That
    is one stored time per batch, so a batch that is run again draws the line where it was.
    """

    def process(events: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            store.compact(run, batch_id)
        earlier = [p for p in store.live("marks") if p.run != run or p.last < batch_id]
        newest = store.partials("marks", earlier).agg(F.max("newest")).first()[0]
        timed = events.select(F.col("timestamp").cast(NTZ).alias("timestamp"), minute_floor("timestamp").alias("minute"))
        timed = timed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ended = F.col("minute") + F.make_dt_interval(mins=F.lit(1))
            is_late = F.lit(False) if newest is None else F.coalesce(ended <= at(newest - delay), F.lit(False))
            counted = timed.groupBy("minute", is_late.alias("late")).agg(F.count("*").alias("visits")).persist()
            for name, kept in (("on_time", ~F.col("late")), ("late", F.col("late"))):
                store.write(name, counted.where(kept).select("minute", "visits"), run, batch_id)
            store.write("marks", timed.agg(F.max("timestamp").alias("newest")), run, batch_id)
            counted.unpersist()
        finally:
            timed.unpersist()

    return process


def start_late_stream(
    events: DataFrame,
    store: PartialStore,
    checkpoint: str,
    delay: timedelta,
    run: str = "late",
    trigger: dict | None = None,
    compact_every: int = 500,
) -> StreamingQuery:
    """Events with a ``timestamp`` to the tables ``on_time`` and ``late`` of a store, ``minute, visits`` each.

    What is on time adds up to a final figure ``delay`` after its minute; what came later is told apart with the minute it belongs to. Together
    they are all events, however they were cut into batches.
    """
    return (
        events.writeStream.queryName(run)
        .foreachBatch(late_batch(store, run, delay, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def visits_on_time_and_late(store: PartialStore) -> DataFrame:
    """``minute, on_time, late`` for every minute with an event."""
    sides = [store.read(name).withColumn("side", F.lit(name)) for name in ("on_time", "late")]
    count = lambda name: F.coalesce(F.sum(F.when(F.col("side") == name, F.col("visits"))), F.lit(0)).alias(name)
    return sides[0].unionByName(sides[1]).groupBy("minute").agg(count("on_time"), count("late"))
