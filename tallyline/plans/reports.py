"""The reports over a store of web metrics: minute series, newest minute first, and the variant overlap."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.time import (
    DEFAULT_MINUTES,
    current_minute,
    newest_first,
    trailing_minutes,
    within_trailing,
)
from tallyline.operators.minute import experiments_report, users_report, visits_report
from tallyline.operators.overlap import folded_overlap
from tallyline.sources.store import PartialStore


def _axis_and_metric(
    store: PartialStore, table: str, minutes: int, asof: datetime | None
) -> tuple[DataFrame, DataFrame]:
    """The axis, and the stored metric within it; the range reaches the scan of files that are sorted by minute."""
    asof = asof or current_minute()
    metric = within_trailing(store.read(table), minutes, asof, "minute")
    return trailing_minutes(store.spark, minutes, asof), metric


def times(spark: SparkSession, minutes: int = DEFAULT_MINUTES, asof: datetime | None = None) -> DataFrame:
    """The axis alone, newest first."""
    return newest_first(trailing_minutes(spark, minutes, asof))


def visits(store: PartialStore, minutes: int = DEFAULT_MINUTES, asof: datetime | None = None) -> DataFrame:
    return newest_first(visits_report(*_axis_and_metric(store, "minutes", minutes, asof)))


def users(store: PartialStore, minutes: int = DEFAULT_MINUTES, asof: datetime | None = None) -> DataFrame:
    return newest_first(users_report(*_axis_and_metric(store, "minutes", minutes, asof)))


def experiments(store: PartialStore, minutes: int = DEFAULT_MINUTES, asof: datetime | None = None) -> DataFrame:
    return newest_first(experiments_report(*_axis_and_metric(store, "experiments", minutes, asof)))


def closed_minutes(store: PartialStore, minutes: int) -> DataFrame:
    """Visits of every minute that ended ``minutes`` or more before the newest event, from all partials.

    Late events count wherever they fall, so how the events came in batches makes no difference.
    """
    newest = F.max("minute").over(Window.partitionBy())  # one row per minute of the calendar
    merged = store.read("minutes").select("minute", "visits", newest.alias("newest"))
    last = F.col("newest") - F.make_dt_interval(mins=F.lit(minutes + 1))
    return merged.where(F.col("minute") <= last).select("minute", "visits")


def variants_overlap(store: PartialStore) -> DataFrame:
    """Common users of every pair of variants, from the folded changes: at most a row per pair and stored batch is read, no set."""
    return folded_overlap(store.read("overlap"))
