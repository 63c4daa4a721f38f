"""Change messages to counters, continuously."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.counters import stock_movement
from tallyline.operators.enrich import branch_misses
from tallyline.operators.parse import accepted, only_rejected_text, parse_cdc, reject_counts, rejected
from tallyline.session import shuffles_end_with_query, uncompressed_cache
from tallyline.sources.lookup import RefreshingLookup
from tallyline.sources.store import PartialStore

COMPACT_EVERY = 500
FULL_EVERY = 20 * COMPACT_EVERY


def stock_batch(
    store: PartialStore,
    lookup: RefreshingLookup,
    run: str,
    company: str = "1",
    compact_every: int = COMPACT_EVERY,
    dead_letters: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """What to do with each micro-batch of parsed messages: one parse, several outputs.

    Unusable messages are kept in full in the store, or in the folder ``dead_letters`` if that is given.
    """

    def process(parsed: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            store.compact(run, batch_id, full=batch_id % FULL_EVERY == 0)
        branches = lookup.get()
        with uncompressed_cache(parsed.sparkSession):
            parsed = only_rejected_text(parsed).drop("ts_ms").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            movements = accepted(parsed)
            store.keep_rejected(rejected(parsed), run, batch_id, dead_letters)
            store.write("counters", stock_movement(movements, branches, company), run, batch_id)
            store.write("misses", branch_misses(movements, branches), run, batch_id)
            store.write("rejects", reject_counts(parsed), run, batch_id)
        finally:
            parsed.unpersist()

    return process


def start_stock_stream(
    messages: DataFrame,
    store: PartialStore,
    lookup: RefreshingLookup,
    checkpoint: str,
    run: str = "stock",
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Run until stopped, or over what is there with ``trigger={"availableNow": True}``.

    ``run`` has to change with the checkpoint, because a new checkpoint numbers its batches from 0 again.
    The counts of read and unusable messages of each batch are in the query's progress. Messages may be shuffled on their way: a batch's
    shuffles are removed as it ends.
    """
    parsed = parse_cdc(messages, kept=True).observe(
        "messages", F.count(F.lit(1)).alias("read"), F.count("reason").alias("unusable")
    )
    writer = (
        parsed.writeStream.queryName(run)
        .foreachBatch(stock_batch(store, lookup, run, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    with shuffles_end_with_query(messages.sparkSession):
        return writer.start()
