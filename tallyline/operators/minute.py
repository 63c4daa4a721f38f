"""Web metrics per minute: visits, approximate users, live experiments.

Partials are what a batch of events adds; they merge in any order, so late events need no special care.
A report puts merged partials on the dense trailing-minute axis, zero where nothing happened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.time import minute_floor

# Size of the sketch, as a power of two: about 0.8 % standard error.
SKETCH_BITS = 14


def minute_partials(events: DataFrame, *by: str) -> DataFrame:
    """Visits and user sketch per minute; ``by`` keeps batches apart."""
    return events.groupBy(*by, minute_floor("timestamp").alias("minute")).agg(
        F.count("*").alias("visits"), F.hll_sketch_agg("uid", F.lit(SKETCH_BITS)).alias("users")
    )


def merge_minutes(partials: DataFrame) -> DataFrame:
    """Fold partials to one row per minute."""
    return partials.groupBy("minute").agg(
        F.sum("visits").alias("visits"), F.hll_union_agg("users").alias("users")
    )


def experiment_partials(events: DataFrame, *by: str) -> DataFrame:
    """The distinct experiments of each minute, one row each; ``by`` keeps batches apart."""
    return events.select(*by, minute_floor("timestamp").alias("minute"), "experiment_id").distinct()


def experiment_bitmaps(events: DataFrame, *by: str) -> DataFrame:
    """The experiments of each minute as bitmaps of 32,768 numbers: one row per minute and bucket of numbers, however many events.

    An event without an experiment leaves an empty bitmap. ``by`` keeps batches apart.
    """
    number = F.col("experiment_id").cast("bigint")
    placed = events.select(
        *by,
        minute_floor("timestamp").alias("minute"),
        F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).alias("bit"),
    )
    return placed.groupBy(*by, "minute", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def merge_experiments(partials: DataFrame) -> DataFrame:
    """Fold bitmaps to one row per minute and bucket. The union of bitmaps is exact."""
    return partials.groupBy("minute", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def experiment_counts(bitmaps: DataFrame) -> DataFrame:
    """Exact number of experiments of each minute, from folded bitmaps."""
    return bitmaps.groupBy("minute").agg(F.sum(F.bitmap_count("bitmap")).alias("metric"))


def _on_axis(axis: DataFrame, metric: DataFrame) -> DataFrame:
    """Every minute of the axis, with zero where the metric has no row."""
    return axis.join(metric.withColumnRenamed("minute", "timestamp"), "timestamp", "left").select(
        "timestamp", F.coalesce("metric", F.lit(0)).cast("double").alias("metric")
    )


def visits_report(axis: DataFrame, minutes: DataFrame) -> DataFrame:
    """Visits per minute."""
    return _on_axis(axis, minutes.select("minute", F.col("visits").alias("metric")))


def users_report(axis: DataFrame, minutes: DataFrame) -> DataFrame:
    """Approximate unique users per minute."""
    return _on_axis(axis, minutes.select("minute", F.hll_sketch_estimate("users").alias("metric")))


def experiments_report(axis: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Exact number of live experiments per minute, from folded bitmaps."""
    return _on_axis(axis, experiment_counts(bitmaps))


def trailing_report(per_minute: DataFrame, minutes: int) -> DataFrame:
    """The last complete minutes before the newest ``minute``, from rows ``minute, metric``, in one pass over them.

    The newest minute yields the axis, with zeros, and every minute on it adds its metric. One task sees one row per
    minute to find the newest: half a million a year however many events there are. No rows give no report.
    """
    newest = F.max("minute").over(Window.partitionBy())
    axis = F.transform(
        F.sequence(F.lit(1), F.lit(max(minutes, 1))),
        lambda back: F.struct((F.col("asof") - F.make_dt_interval(mins=back)).alias("timestamp"), F.lit(0.0).alias("metric")),
    )
    own = F.array(F.struct(F.col("minute").alias("timestamp"), F.col("metric").cast("double").alias("metric")))
    first = F.col("asof") - F.make_dt_interval(mins=F.lit(minutes))
    points = F.when(F.col("minute") == F.col("asof"), axis).when(F.col("minute") >= first, own)
    shown = per_minute.withColumn("asof", newest).where(F.lit(minutes > 0)).select(F.explode(points).alias("p"))
    return shown.groupBy("p.timestamp").agg(F.sum("p.metric").alias("metric"))


def approximate_users(events: DataFrame, *by: str) -> DataFrame:
    """Approximate users per group. Only sketches are shuffled, whatever the number of users."""
    sketch = F.hll_sketch_agg("uid", F.lit(SKETCH_BITS))
    return events.groupBy(*by).agg(F.hll_sketch_estimate(sketch).alias("approximate"))


def exact_users(events: DataFrame, *by: str) -> DataFrame:
    """Exact users per group, to compare with."""
    users = events.select(*by, "uid").where("uid IS NOT NULL").distinct()
    return users.groupBy(*by).agg(F.count("*").alias("exact"))
