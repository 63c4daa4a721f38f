"""Counters in Spark's own state store: totals that are right after every batch, with nothing to fold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.counters import count_by_key
from tallyline.operators.enrich import enrich
from tallyline.operators.parse import accepted, parse_cdc
from tallyline.operators.route import by_company
from tallyline.sources.lookup import Lookup
from tallyline.sources.store import Family, PartialStore

# Totals live on the executors' disks and only changes are written to the checkpoint. All stores of an executor share one bounded piece of memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def newest_totals(written: DataFrame) -> DataFrame:
    """The newest total of each key."""
    return written.groupBy("counter_key").agg(F.max("batch").alias("batch"), F.max_by("total", "batch").alias("total"))


STATE_FAMILIES = {"totals": Family("counter_key STRING, batch BIGINT, total BIGINT", newest_totals, "counter_key")}


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of queries started from now on in RocksDB."""
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)


def write_totals(store: PartialStore, run: str, compact_every: int) -> Callable[[DataFrame, int], None]:
    """Store the totals that a batch has changed. They are totals and not increments, so writing them twice changes nothing."""

    def process(changed: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            store.compact(run, batch_id, full=True)
        rows = changed.select("counter_key", F.lit(batch_id).cast("bigint").alias("batch"), "total")
        store.write("totals", rows, run, batch_id)

    return process


def start_counter_stream(
    messages: DataFrame,
    store: PartialStore,
    lookup: Lookup,
    checkpoint: str,
    company: str = "1",
    run: str = "totals",
    trigger: dict | None = None,
    compact_every: int = 500,
) -> StreamingQuery:
    """Change messages to totals of one company, as a streaming aggregation in update mode.

    The running sums are the query's state, kept exactly once with its checkpoint: a batch that is repeated after a failure starts
    from the sums before it. Each batch stores the totals of the keys it has met. The lookup is that of the start; a changed one
    counts from the next start on. For one that is read again while the stream runs, see ``streaming.stock``.
    """
    enriched = enrich(accepted(parse_cdc(messages)), lookup).where(by_company(company) == 0)
    return (
        count_by_key(enriched)
        .writeStream.queryName(run)
        .outputMode("update")
        .foreachBatch(write_totals(store, run, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def totals(store: PartialStore) -> DataFrame:
    """The running totals ``counter_key, total`` as of the last stored batch."""
    return store.read("totals").select("counter_key", "total")
