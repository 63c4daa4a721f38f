"""Mergeable partial metrics in plain Parquet folders.

Each micro-batch writes what it adds to the metrics to a folder of its own, named by its number. A batch that is run again overwrites its
folder, so a replay never counts twice. Readers merge all folders. Every so often, small folders are merged by an ordinary
job into one for a range of batches:

    <root>/<table>/run=<run>/first=<a>/last=<b>/part-*.parquet

A folder counts once it is finished (Spark's ``_SUCCESS``), unless a finished folder of the same run with a wider range has it merged. So
a compaction takes effect at once, and one that fails changes nothing. What a compaction has merged stays until the next one,
for readers that have begun on it.

Tables are written one after the other, each complete in itself: while a batch is being replayed, a reader may miss its part in
one of them. ``streaming.state`` keeps counters in Spark's own state store instead, for totals that are visible with every batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.counters import merge_counters
from tallyline.operators.minute import merge_experiments, merge_minutes
from tallyline.operators.overlap import merge_overlap, merge_sets
from tallyline.session import remove


@dataclass(frozen=True)
class Family:
    """A kind of metric: its columns, how partials merge, and the column whose ranges reports read."""

    schema: str
    merge: Callable[[DataFrame], DataFrame]
    sorted_by: str | None = None


def _merge_tally(key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda partials: partials.groupBy(key).agg(F.sum("n").alias("n"))


STOCK_FAMILIES = {
    "counters": Family("counter_key STRING, total BIGINT", merge_counters),
    "rejects": Family("reason STRING, n BIGINT", _merge_tally("reason")),
    "misses": Family("branch STRING, n BIGINT", _merge_tally("branch")),
}

WEB_FAMILIES = {
    "minutes": Family("minute TIMESTAMP_NTZ, visits BIGINT, users BINARY", merge_minutes, "minute"),
    "experiments": Family("minute TIMESTAMP_NTZ, bucket BIGINT, bitmap BINARY", merge_experiments, "minute"),
    "variant_users": Family("set_key STRING, member STRING", merge_sets),
    "overlap": Family("dim_a STRING, dim_b STRING, users BIGINT", merge_overlap),
    "rejects": STOCK_FAMILIES["rejects"],
}


@dataclass(frozen=True)
class Part:
    """A finished folder."""

    run: str
    first: int
    last: int
    path: str

    def has(self, other: Part) -> bool:
        return self != other and self.run == other.run and self.first <= other.first and other.last <= self.last


@dataclass
class PartialStore:
    """The partial tables of one pipeline below a root folder. One writer at a time."""

    spark: SparkSession
    root: str
    families: dict[str, Family] = field(default_factory=dict)

    def _write(self, rows: DataFrame, folder: str) -> None:
        # Static, so that nothing of an earlier attempt survives whatever the session prefers.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)

    def _folder(self, table: str, run: str, first: int, last: int) -> str:
        return f"{self.root}/{table}/run={run}/first={first}/last={last}"

    def write(self, table: str, partials: DataFrame, run: str, batch_id: int) -> None:
        """Store what one batch adds to a table, in place of an earlier attempt at it. There may be several rows of a key."""
        self._write(partials, self._folder(table, run, batch_id, batch_id))

    def keep_rejected(self, messages: DataFrame, run: str, batch_id: int, folder: str | None = None) -> None:
        """Store the unusable messages of one batch in full. They are kept as they came and never merged."""
        self._write(messages, f"{folder or self.root + '/rejected_messages'}/run={run}/batch_id={batch_id}")

    def rejected_messages(self) -> DataFrame:
        """All unusable messages with their reason."""
        return self.spark.read.schema("reason STRING, message STRING").parquet(f"{self.root}/rejected_messages")[["reason", "message"]]

    def parts(self, table: str) -> list[Part]:
        """All finished folders of a table."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/run=*/first=*/last=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
        out = []
        for status in found or []:
            path = status.getPath().getParent().toString()
            run, first, last = (piece.split("=", 1)[1] for piece in path.rsplit("/", 3)[1:])
            out.append(Part(run, int(first), int(last), path))
        return sorted(out, key=lambda p: (p.run, p.first, p.last))

    def live(self, table: str) -> list[Part]:
        """The folders that count: as many as there are batches between two compactions, and one per compaction."""
        parts = self.parts(table)
        return [p for p in parts if not any(q.has(p) for q in parts)]

    def partials(self, table: str, parts: list[Part] | None = None) -> DataFrame:
        """All partials that count."""
        parts = self.live(table) if parts is None else parts
        schema = self.families[table].schema
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(p.path for p in parts))

    def read(self, table: str) -> DataFrame:
        """The metric itself: partials merged. A range of minutes that a report asks for reaches the scan."""
        return self.families[table].merge(self.partials(table))

    def compact(self, run: str, before: int, full: bool = False) -> None:
        """Merge the batches of a run below ``before`` into one folder per table; with ``full`` also what was merged before.

        Called at the start of batch ``before``: the batches before it are closed and will not come again.
        """
        for table, family in self.families.items():
            every, live = self.parts(table), self.live(table)
            for part in every:
                if part not in live:
                    remove(self.spark, part.path)
            closed = [p for p in live if p.run == run and p.last < before and (full or p.first == p.last)]
            if len(closed) < 2:
                continue
            merged = family.merge(self.partials(table, closed))
            if family.sorted_by:
                merged = merged.repartitionByRange(family.sorted_by).sortWithinPartitions(family.sorted_by)
            self._write(merged, self._folder(table, run, closed[0].first, closed[-1].last))
