"""Integer totals per ``branch|company|sku``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.keys import counter_key
from tallyline.operators.enrich import enrich, join_lookup, unassigned
from tallyline.operators.route import by_company
from tallyline.sources.lookup import Lookup


def count_by_key(movements: DataFrame, *by: str) -> DataFrame:
    """Sum of the values per counter key. The map side sums first, so a hot key is a row per task.

    Overflow of the 64-bit total is an error that names the key, as it is for a stored counter. ``by`` keeps
    batches apart.
    """
    values = movements.select(*by, counter_key().alias("counter_key"), F.col("value").cast("bigint").alias("n"))
    return _checked_sum(values, *by, "counter_key")


def _checked_sum(rows: DataFrame, *key: str) -> DataFrame:
    """Sum of ``n`` per key, or an error with the key whose sum is no 64-bit number."""
    sums = rows.where("n IS NOT NULL").groupBy(*key).agg(F.try_sum("n").alias("sum"))
    error = F.raise_error(F.concat(F.lit("counter overflow: "), F.col("counter_key"))).cast("bigint")
    return sums.select(*key, F.coalesce("sum", error).alias("total"))


def merge_counters(partials: DataFrame) -> DataFrame:
    """Fold partial totals; the order they come in does not matter."""
    return _checked_sum(partials.select("counter_key", F.col("total").alias("n")), "counter_key")


def stock_movement(movements: DataFrame, lookup: Lookup, company: str = "1") -> DataFrame:
    """Totals of one company's movements.

    With a replicated lookup, the join drops other companies before anything is shuffled. A larger lookup
    has to be joined through a shuffle, so the movements are summed per branch and sku before it.
    """
    if lookup.fits_broadcast:
        return count_by_key(enrich(movements, lookup).where(by_company(company) == 0))
    summed = (
        unassigned(movements)
        .groupBy("branch", "sku")
        .agg(F.try_sum(F.col("value").cast("bigint")).alias("value"))
    )
    found = join_lookup(summed, lookup, ["branch"])
    wanted = found.where(by_company(company) == 0)
    # Only the wanted company's overflow is an error.
    error = F.raise_error(F.concat(F.lit("counter overflow: "), counter_key()))
    checked = F.when(F.col("value").isNull(), error.cast("bigint")).otherwise(F.col("value"))
    return count_by_key(wanted.withColumn("value", checked))
