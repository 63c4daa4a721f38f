"""The engine's inputs taken from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.time import utc_millis
from tallyline.operators.overlap import memberships
from tallyline.sources.lookup import scan_lookup
from tallyline.sources.messages import stream_table

# Key of a lineitem row.
LINE = ["l_orderkey", "l_linenumber"]

# Bytes of table files in one micro-batch. A batch keeps its parsed messages while it writes its outputs, so
# the whole of a large table must not be one batch. This paces a stream and drops nothing.
BATCH_BYTES = 16 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, scan: DataFrame, *by: str) -> DataFrame:
    """Give every core a share of a table that is stored in fewer pieces than there are cores.

    A table of some size has far more pieces and is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, *by) if scan.rdd.getNumPartitions() < cores else rows


def _operation() -> Column:
    """Changes are creates, updates and snapshot reads in turn."""
    return F.element_at(F.lit(["c", "u", "r"]), F.col("l_linenumber") % 3 + 1)


def cdc_message(**extra: Column) -> Column:
    """Change message of a lineitem row: supplier as branch, part as sku, quantity as value."""
    after = F.struct(
        F.col("l_suppkey").alias("branch_id_no"),
        F.col("l_partkey").alias("sku_no"),
        F.col("l_quantity").cast("bigint").alias("value"),
        F.col("l_returnflag").alias("reason"),
    )
    fields = {
        "after": after,
        "source": F.struct(F.lit("stock").alias("table"), F.col("l_orderkey").alias("row")),
        "op": _operation(),
        "ts_ms": utc_millis("l_shipdate"),
        **extra,
    }
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))


def cdc_messages(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(cdc_message().alias("value"))


def bus_messages(lineitem: DataFrame) -> DataFrame:
    """Change messages as a bus hands them on: with an id, and the time of publication, which three parts of the orders have in turn."""
    part = F.col("l_orderkey") % 3
    published = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=part.cast("int"), secs=F.col("l_linenumber"))
    message_id = F.sha2(F.to_json(F.struct("*")), 256)
    return lineitem.select(message_id.alias("message_id"), published.alias("published_at"), cdc_message().alias("value"))


def damaged_cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages of which six in ten cannot be used, each tenth in another way."""
    kind = F.col("l_orderkey") % 10
    without_sku = F.struct(F.col("l_suppkey").alias("branch_id_no"), F.lit(1).alias("value"))
    fraction = F.struct(
        F.col("l_suppkey").alias("branch_id_no"),
        F.col("l_partkey").alias("sku_no"),
        (F.col("l_quantity") + 0.5).alias("value"),
    )
    damaged = (
        F.when(kind == 0, F.concat(F.lit("order "), F.col("l_orderkey").cast("string")))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, cdc_message(shard=F.col("l_linenumber")))
        .when(kind == 3, cdc_message(after=F.lit(None).cast("string")))
        .when(kind == 4, cdc_message(after=without_sku))
        .when(kind == 5, cdc_message(after=fraction))
        .otherwise(cdc_message())
    )
    lineitem = table(spark, sf_dir, "lineitem")
    return spread(lineitem, lineitem, *LINE).select(damaged.alias("value"))


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages of the whole lineitem table."""
    lineitem = table(spark, sf_dir, "lineitem")
    return cdc_messages(spread(lineitem, lineitem, *LINE))


def streamed_change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream."""
    stream = stream_table(spark, f"{sf_dir}/lineitem.parquet", max_bytes=BATCH_BYTES)
    return cdc_messages(spread(stream, table(spark, sf_dir, "lineitem"), *LINE))


def streamed_part_damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages of which every tenth order is plain text and every tenth has no text, as a stream."""
    kind = F.col("l_orderkey") % 10
    text = F.concat_ws(" ", F.lit("order"), "l_orderkey", "l_linenumber")
    damaged = F.when(kind == 0, text).when(kind == 1, F.lit("")).otherwise(cdc_message())
    stream = stream_table(spark, f"{sf_dir}/lineitem.parquet", max_bytes=BATCH_BYTES)
    return spread(stream, table(spark, sf_dir, "lineitem"), *LINE).select(damaged.alias("value"))


def branch_lookup(supplier: DataFrame) -> DataFrame:
    """Nine in ten suppliers as branches of three companies."""
    rows = supplier.where("s_suppkey % 10 <> 7").select(
        F.col("s_suppkey").alias("branch_id"), (F.col("s_nationkey") % 3).alias("cpy_id")
    )
    return scan_lookup(rows)


def web_events(events: DataFrame) -> DataFrame:
    """The events table with the names of the web event."""
    return events.select(
        F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("experiment_id"),
        F.col("event_type").alias("variant"),
        F.col("ts").alias("timestamp"),
    )


def web_messages(events: DataFrame) -> DataFrame:
    """Web event messages; the message has whole seconds."""
    second = F.translate(F.substring(F.col("timestamp").cast("string"), 1, 19), " ", "T")
    rows = web_events(events).withColumn("timestamp", F.concat(second, F.lit("Z")))
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def visit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web event messages of the whole events table."""
    events = table(spark, sf_dir, "events")
    return web_messages(spread(events, events, "event_id"))


def streamed_visit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream."""
    stream = stream_table(spark, f"{sf_dir}/events.parquet", max_bytes=BATCH_BYTES)
    return web_messages(spread(stream, table(spark, sf_dir, "events"), "event_id"))


def order_sets(orders: DataFrame) -> DataFrame:
    """User sets with the order priority as the variant and the customer as the user."""
    return memberships(orders.select(F.col("o_orderpriority").alias("variant"), F.col("o_custkey").alias("uid")))


def branch_movements(events: DataFrame) -> DataFrame:
    """Movements with a time, from events: ten branches, the event value as text."""
    return events.select(
        F.col("event_id"),
        (F.col("user_id") % 10).cast("string").alias("branch"),
        F.lit("").alias("company"),
        F.col("user_id").cast("string").alias("sku"),
        F.col("ts").alias("timestamp"),
    )
