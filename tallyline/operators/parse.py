"""JSON messages to rows, with a reason for every message that cannot be used.

Parsing gives one row per message: the extracted fields and ``reason``, which is null for a good one.
``accepted`` and ``rejected`` are the two sides; a job never fails on a bad message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.time import NTZ
from tallyline.schemas import (
    CDC_FIELDS,
    CDC_SCHEMA,
    JSON_OPTIONS,
    WEB_SCHEMA,
    WEB_TIMESTAMP_PATTERN,
)

MALFORMED = "malformed"
UNKNOWN_FIELD = "unknown_field"
MISSING_FIELD = "missing_field"
BAD_VALUE = "bad_value"
BAD_TIMESTAMP = "bad_timestamp"


def _once(messages: DataFrame, parsed: Column) -> DataFrame:
    """Evaluate ``parsed`` one time per message.

    Catalyst moves a later filter below a projection and would repeat the JSON parse in both. It does not
    move a filter below the generator that made its columns.
    """
    return messages.select("value", F.explode(F.array(parsed)).alias("m"))


def _has_unknown(names: str) -> Column:
    """Whether any top-level field of a change message is none of the known ones.

    As many names as known ones among them leave no room for another. Only other messages (a repeated name is no unknown one) are compared name by name.
    """
    known = sum(F.array_contains(names, name).cast("int") for name in CDC_FIELDS)
    return (F.size(names) != known) & (F.size(F.array_except(names, F.lit(CDC_FIELDS))) > 0)


def parse_cdc(messages: DataFrame, kept: bool = False) -> DataFrame:
    """Change messages in ``value`` to movements ``branch, company, sku, value`` with ``ts_ms``.

    All of create, update, snapshot and delete count alike: only the row image in ``after`` is read. An empty
    message parses to nothing, and any other unreadable one keeps its text in ``_malformed``.

    ``kept`` is for rows that are kept before anything filters them: no filter can repeat the parse, which then needs no generator.
    """
    both = F.struct(
        F.from_json("value", CDC_SCHEMA, JSON_OPTIONS).alias("body"),
        F.json_object_keys("value").alias("fields"),
    )
    parsed = messages.select("value", both.alias("m")) if kept else _once(messages, both)
    body, after = F.col("m.body"), F.col("m.body.after")
    fraction = body["ts_ms"].try_cast("decimal(38,6)")
    ts_ms = F.coalesce(body["ts_ms"].try_cast("bigint"), fraction.try_cast("bigint"))
    present = after["branch_id_no"].isNotNull() & after["sku_no"].isNotNull() & after["value"].isNotNull()
    whole = after["value"].rlike("^[+-]?[0-9]+$") & after["value"].try_cast("bigint").isNotNull()
    reason = (
        F.when(body.isNull() | body["_malformed"].isNotNull() | F.col("m.fields").isNull(), MALFORMED)
        .when(_has_unknown("m.fields"), UNKNOWN_FIELD)
        .when((body["ts_ms"] != "") & ts_ms.isNull(), MALFORMED)
        .when(~F.coalesce(present, F.lit(False)), MISSING_FIELD)
        .when(~F.coalesce(whole, F.lit(False)), BAD_VALUE)
    )
    return parsed.select(
        F.col("value").alias("message"),
        after["branch_id_no"].alias("branch"),
        F.lit("").alias("company"),
        after["sku_no"].alias("sku"),
        after["value"].alias("value"),
        F.coalesce(ts_ms, F.lit(0).cast("bigint")).alias("ts_ms"),
        reason.alias("reason"),
    )


def parse_web(messages: DataFrame) -> DataFrame:
    """Web event messages in ``value`` to ``uid, experiment_id, variant, timestamp``."""
    parsed = _once(messages, F.struct(F.from_json("value", WEB_SCHEMA, JSON_OPTIONS).alias("body")))
    body = F.col("m.body")
    uid = body["uid"].try_cast("bigint")
    experiment = body["experiment_id"].try_cast("int")
    whole = body["timestamp"].rlike(WEB_TIMESTAMP_PATTERN)
    moment = F.when(whole, F.substring(body["timestamp"], 1, 19).try_cast(NTZ))
    absent = (
        body["uid"].isNull()
        | body["experiment_id"].isNull()
        | body["variant"].isNull()
        | body["timestamp"].isNull()
    )
    reason = (
        F.when(body.isNull() | body["_malformed"].isNotNull(), MALFORMED)
        .when(absent, MISSING_FIELD)
        .when(uid.isNull() | experiment.isNull(), BAD_VALUE)
        .when(moment.isNull(), BAD_TIMESTAMP)
    )
    return parsed.select(
        F.col("value").alias("message"),
        uid.alias("uid"),
        experiment.alias("experiment_id"),
        body["variant"].alias("variant"),
        moment.alias("timestamp"),
        reason.alias("reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows of the good messages."""
    return parsed.where(F.col("reason").isNull()).drop("message", "reason")


def rejected(parsed: DataFrame) -> DataFrame:
    """The unusable messages in full, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("reason", "message")


def only_rejected_text(parsed: DataFrame) -> DataFrame:
    """Without the text of good messages, which nothing reads any more."""
    return parsed.withColumn("message", F.when(F.col("reason").isNotNull(), F.col("message")))


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Number of unusable messages per reason."""
    return rejected(parsed).groupBy("reason").agg(F.count("*").alias("n"))
