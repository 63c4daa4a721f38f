"""Sharding by histogram sort: shards of nearly equal bytes, in the order of a key, with one exchange.

The key is 63 bits: 32 of the text's hash, then 31 of the id's, so equal texts are neighbours. To find the keys at which
shards begin, every pass counts the exact bytes and rows below candidate keys: tasks bin their own rows between the
candidates (numpy ``searchsorted``), and only bin totals are summed. Each wanted position keeps the nearest candidate on
either side and spreads new ones between them, until a candidate is within the tolerance. Only then do rows move, once.

Candidates fall between texts first: copies of a text stay in one shard. Only where a group of copies is larger
than the tolerance allows do candidates go on inside it, along the ids, so that a group with a third of all bytes is
spread over as many shards as its bytes need.

A shard is cut into parts by the same search, at least ``PARTS`` and as many more as keep a part near ``PART_BYTES``, so what
a task orders and numbers does not grow with the table; the rows before each part are known from the last count. The driver holds
(shards * parts * probes) numbers: some 40 MB for 100 TB.

Defined results: a null text has no bytes and the digest 0 of an empty one. Rows equal in id and text have one key and
stay together. Rows of one key are ordered by the remaining order columns. An empty table gives an empty result. Further
columns are carried along unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialize

SHARDS = 8
PARTS = 32
PART_BYTES = 1 << 30
PROBES = 16
TOLERANCE = 0.01
KEY_END = 1 << 63
TEXT_STEP = 1 << 31


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one, so that empty rows count too."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def sort_key(text: Column, identity: Column) -> Column:
    high = F.shiftright(F.xxhash64(F.coalesce(text, F.lit(""))), 32).bitwiseAND(F.lit(0xFFFFFFFF))
    low = F.xxhash64(identity).bitwiseAND(F.lit(TEXT_STEP - 1))
    return F.shiftleft(high, 31).bitwiseOR(low)


def count_below(keyed: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe, and in all, from one pass over (key, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(probes) + 1), np.int64)
        for batch in batches:
            bins = np.searchsorted(probes, batch.column(0).to_numpy(), "right")
            order = np.argsort(bins, kind="stable")
            at, first = np.unique(bins[order], return_index=True)
            if len(at):
                sums[0, at] += np.add.reduceat(batch.column(1).to_numpy()[order], first)
                sums[1] += np.bincount(bins, minlength=len(probes) + 1)
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["bin", "bytes", "n"])

    bins = keyed.select("key", "size").mapInArrow(run, "bin bigint, bytes bigint, n bigint")
    totals = np.zeros((2, len(probes) + 1), np.int64)
    found = bins.groupBy("bin").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).toArrow()
    totals[:, found["bin"].to_numpy()] = found["bytes"].to_numpy(), found["n"].to_numpy()
    return np.cumsum(totals[0]), np.cumsum(totals[1])


def find_splitters(keyed: DataFrame, total: int, shards: int, parts: int, tolerance: float) -> np.ndarray:
    """The keys at which every part but the first begins, in ascending order; ``total`` is the sum of all sizes."""
    pieces = shards * parts
    wanted = [total * i // pieces for i in range(1, pieces)]
    slack = [tolerance * total / (shards if i % parts == 0 else pieces / 10) for i in range(1, pieces)]
    low, high = [(0, 0)] * len(wanted), [(KEY_END, total)] * len(wanted)
    row_low, row_high = [0] * len(wanted), [None] * len(wanted)

    def best(i: int) -> tuple[int, int]:
        return min(low[i], high[i], key=lambda x: abs(x[1] - wanted[i]))

    def settled(i: int) -> bool:
        alone = row_high[i] is not None and row_high[i] - row_low[i] <= 1
        return abs(best(i)[1] - wanted[i]) <= slack[i] or high[i][0] - low[i][0] <= 1 or alone

    while open_now := [i for i in range(len(wanted)) if not settled(i)]:
        probes = sorted({p for i in open_now for p in candidates(low[i][0], high[i][0])})
        below, rows = count_below(keyed, np.array(probes, np.int64))
        for i in open_now:
            at = int(np.searchsorted(below[: len(probes)], wanted[i], "right"))
            if at > 0 and probes[at - 1] > low[i][0]:
                low[i], row_low[i] = (probes[at - 1], int(below[at - 1])), int(rows[at - 1])
            if at < len(probes) and probes[at] < high[i][0]:
                high[i], row_high[i] = (probes[at], int(below[at])), int(rows[at])
    return np.array(sorted(min(best(i)[0], KEY_END - 1) for i in range(len(wanted))), np.int64)


def candidates(low: int, high: int) -> set[int]:
    """Up to PROBES keys strictly between the two, only at text boundaries as long as there are any."""
    step = TEXT_STEP if high // TEXT_STEP > low // TEXT_STEP + (high % TEXT_STEP == 0) else 1
    first, last = low // step + 1, (high - 1) // step
    count = min(PROBES, last - first + 1)
    return {(first + (last - first) * k // max(count - 1, 1)) * step for k in range(count)}


def place(rows: DataFrame, splitters: np.ndarray, first_slot: np.ndarray) -> DataFrame:
    """Adds to rows with a ``key`` the ``part`` that they are in and the slot at which it begins."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    shared = rows.sparkSession.sparkContext.broadcast((splitters, first_slot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, first = shared.value
        for batch in batches:
            part = np.searchsorted(bounds, batch.column("key").to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(first[part])], [*kinds, "part", "first_slot"])

    return rows.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in [*kinds.items(), ("part", "bigint"), ("first_slot", "bigint")]))


def add_shards(
    rows: DataFrame, keyed: DataFrame, order: list[str], shards: int = SHARDS, parts: int | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows that have a ``key``; ``keyed`` holds the same keys with sizes, cheap to read."""
    total = int(count_below(keyed, np.zeros(0, np.int64))[0][0])
    parts = parts or max(PARTS, -(-total // (shards * PART_BYTES)))
    splitters = find_splitters(keyed, total, shards, parts, tolerance)
    starts = np.append(0, count_below(keyed, splitters)[1][:-1])
    first_slot = starts - starts[np.arange(shards * parts) // parts * parts]
    placed = place(rows, splitters, first_slot)
    within = F.row_number().over(Window.partitionBy("part").orderBy("key", *order)) - 1
    shard = F.floor(F.col("part") / parts).cast("int")
    slot = (F.col("first_slot") + within).cast("long")
    return placed.withColumn("slot", slot).withColumn("shard", shard).drop("part", "first_slot")


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    parts: int | None = None,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = True,
) -> DataFrame:
    """Size, text digest, shard and slot of every row; with ``carry`` also the row itself as the struct ``row``."""
    text = F.col(text_col).cast("string")
    digest = F.coalesce(F.crc32(text), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        byte_size(text).alias("size"),
        digest.alias("text_crc32"),
        sort_key(text, F.col(id_col)).alias("key"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []),
    )
    keyed = materialize(rows.drop("row"), "shard-keys")
    return add_shards(rows if carry else keyed, keyed, ["doc_id", "text_crc32", "size"], shards, parts, tolerance).drop("key")
