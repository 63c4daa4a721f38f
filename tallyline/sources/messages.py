"""Message sources: one row per message, text in ``value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of text files, one per line."""
    return spark.read.text(path)


# What one micro-batch takes at most. It paces a stream that begins with a long history and drops nothing.
FILES_PER_BATCH = 1_000
OFFSETS_PER_BATCH = 50_000_000


def stream_messages(spark: SparkSession, path: str, max_files: int = FILES_PER_BATCH) -> DataFrame:
    """Messages of text files as they arrive in a folder."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int = OFFSETS_PER_BATCH) -> DataFrame:
    """Messages of a Kafka topic; the session needs Spark's Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
    )
    return reader.load().select(F.col("value").cast("string").alias("value"))


def _packed(text: Column) -> Column:
    """A text of pairs of hexadecimal digits in lower case, as hashes are, as a 1 and their bytes, any other as a 0 and its own bytes."""
    digits = F.unhex(text)
    packed = F.concat(F.lit(b"\x01"), digits)
    return F.when(F.lower(F.hex(digits)) == text, packed).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def _unpacked(packed: Column) -> Column:
    """The text that was packed."""
    rest = packed.substr(F.lit(2), F.octet_length(packed))
    return F.when(packed.substr(1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def drop_redelivered(messages: DataFrame, message_id: str, published_at: str, within: str) -> DataFrame:
    """Each message of an at-least-once bus once: the first delivery of an id, if later ones follow within ``within``.

    ``published_at`` is the bus's own time of the message, the same for all its deliveries. Ids are forgotten once the newest time is
    ``within`` past theirs, so state is bounded by the messages of that span; a message delivered for the first time later than that is
    dropped too. ``within`` is therefore the longest time for which the bus goes on delivering.

    Every id is kept in the state and its changelog and every message is shuffled with its id, so ids of text are packed meanwhile.
    """
    timed = messages.withColumn("_published", F.col(published_at).cast("timestamp")).withWatermark("_published", within)
    if messages.select(message_id).schema[0].dataType != StringType():
        return timed.dropDuplicatesWithinWatermark([message_id]).drop("_published")
    packed = timed.withColumn(message_id, _packed(F.col(message_id)))
    once = packed.dropDuplicatesWithinWatermark([message_id])
    return once.withColumn(message_id, _unpacked(F.col(message_id))).drop("_published")


def stream_table(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Rows of a Parquet table, a single file or a folder of files, as a stream.

    The last character goes in as a pattern that matches only itself: the source takes a single file by
    pattern, but not by name.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
