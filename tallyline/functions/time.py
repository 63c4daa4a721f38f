"""Minute buckets, time keys and the trailing-minute axis."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: minutes a report covers unless told otherwise.
DEFAULT_MINUTES = 10

NTZ = "timestamp_ntz"


def _column(ts: Column | str) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def minute_floor(ts: Column | str) -> Column:
    """Start of the minute that holds the naive UTC time ``ts``. No step goes through the session's time zone."""
    ts = _column(ts)
    return ts - F.make_dt_interval(secs=F.date_part(F.lit("SECOND"), ts))


def day_floor(ts: Column | str) -> Column:
    """Start of the day that holds the naive UTC time ``ts``."""
    return _column(ts).cast("date").cast(NTZ)


def minute_key(prefix: str, ts: Column | str) -> Column:
    """Text key of a naive UTC minute, for instance ``visitCounter_2024_01_31T09_05``."""
    minute = F.substring(_column(ts).cast(NTZ).cast("string"), 1, 16)
    return F.concat(F.lit(f"{prefix}_"), F.translate(minute, "- :", "_T_"))


def utc_instant(ts: Column | str) -> Column:
    """The instant of a naive UTC time, whatever the session's time zone."""
    return F.concat(_column(ts).cast("string"), F.lit("Z")).cast("timestamp")


def utc_millis(ts: Column | str) -> Column:
    """``unix_millis`` of the instant of a naive UTC time, from its fields and without a text in between."""
    ts = _column(ts)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    millis = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return ((days * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000 + millis


def at(moment: datetime) -> Column:
    """A naive UTC datetime as a literal that is independent of the driver's own time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast(NTZ)


def current_minute() -> datetime:
    """The running UTC minute."""
    return datetime.now(timezone.utc).replace(second=0, microsecond=0, tzinfo=None)


def latest_minute(events: DataFrame, ts: str = "timestamp") -> datetime:
    """The minute of the newest event: a repeatable stand-in for the running minute. Runs a job."""
    newest = events.agg(F.max(F.col(ts).cast(NTZ))).first()[0]
    return (newest or current_minute()).replace(second=0, microsecond=0)


def trailing_minutes(
    spark: SparkSession, minutes: int = DEFAULT_MINUTES, asof: datetime | None = None
) -> DataFrame:
    """The last complete minutes before ``asof``, one row each; empty for a count of zero or less."""
    asof = asof or current_minute()
    back = F.make_dt_interval(mins=F.col("id").cast("int"))
    return spark.range(1, max(minutes, 0) + 1).select((at(asof) - back).alias("timestamp"))


def within_trailing(
    events: DataFrame, minutes: int, asof: datetime, ts: str = "timestamp"
) -> DataFrame:
    """Keep the events of the trailing minutes. The bounds are literals, so they reach the file scan."""
    start = asof - timedelta(minutes=max(minutes, 0))
    return events.where((F.col(ts) >= at(start)) & (F.col(ts) < at(asof)))


def newest_first(points: DataFrame) -> DataFrame:
    """Order of a report; applied at the edge only."""
    return points.orderBy(F.desc("timestamp"))
