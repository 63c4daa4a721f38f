"""Web events to minute metrics and variant sets, continuously."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.time import NTZ
from tallyline.operators.minute import experiment_bitmaps, minute_partials
from tallyline.operators.overlap import overlap_delta, variant_users
from tallyline.operators.parse import accepted, only_rejected_text, parse_web, reject_counts, rejected
from tallyline.sources.store import PartialStore

COMPACT_EVERY = 500
FULL_EVERY = 20 * COMPACT_EVERY


def web_batch(store: PartialStore, run: str, compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """What to do with each micro-batch of parsed messages: one parse, all metric families.

    What a batch changes in the overlaps follows from the sets of the batches before it, whose rows of the batch's users are looked up
    by a semi-join. A replay finds the same sets, as it leaves out its own batch and later ones.
    """

    def process(parsed: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            store.compact(run, batch_id, full=batch_id % FULL_EVERY == 0)
        parsed = only_rejected_text(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = accepted(parsed)
            store.keep_rejected(rejected(parsed), run, batch_id)
            store.write("minutes", minute_partials(events), run, batch_id)
            store.write("experiments", experiment_bitmaps(events), run, batch_id)
            store.write("rejects", reject_counts(parsed), run, batch_id)
            sets = variant_users(events)
            earlier = [p for p in store.live("variant_users") if p.run != run or p.last < batch_id]
            store.write("overlap", overlap_delta(sets, store.partials("variant_users", earlier)), run, batch_id)
            store.write("variant_users", sets, run, batch_id)
        finally:
            parsed.unpersist()

    return process


def start_web_stream(
    messages: DataFrame,
    store: PartialStore,
    checkpoint: str,
    run: str = "web",
    trigger: dict | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Run until stopped, or over what is there with ``trigger={"availableNow": True}``.

    ``run`` has to change with the checkpoint, because a new checkpoint numbers its batches from 0 again.
    """
    parsed = parse_web(messages).observe(
        "messages", F.count(F.lit(1)).alias("read"), F.count("reason").alias("unusable")
    )
    return (
        parsed.writeStream.queryName(run)
        .foreachBatch(web_batch(store, run, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def closed_minutes(events: DataFrame, delay: str) -> DataFrame:
    """Visits of each minute as a watermarked streaming aggregate.

    In append mode a minute comes out once, when ``delay`` has passed it, and events later than that are
    dropped: what is dropped depends on how the events came in batches. ``reports.closed_minutes`` gives the
    same minutes from the partial tables and drops nothing.
    """
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)
    counted = timed.groupBy(F.window("timestamp", "1 minute")).agg(F.count("*").alias("visits"))
    return counted.select(F.col("window.start").cast(NTZ).alias("minute"), "visits")
