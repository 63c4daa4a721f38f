"""Sorted runs of rows in Arrow batches, and connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize


def run_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The rows at which a run of equal keys begins, followed by the number of rows. Nulls equal nulls."""
    if not table.num_rows:
        return np.zeros(1, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        column = table.column(key).combine_chunks()
        now, before = column.slice(1), column.slice(0, len(column) - 1)
        new[1:] |= pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
        new[1:] |= pc.not_equal(now.is_null(), before.is_null()).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), table.num_rows)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of sorted rows cut anew so that no run of equal keys is divided; with the starts of the runs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = run_starts(pa.Table.from_batches([*held[-1:], batch]), keys)
        shift = held[-1].num_rows if held else 0
        cut = int(starts[-2]) - shift
        if cut < 0:
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch.slice(0, cut)])
        if table.num_rows:
            yield table, run_starts(table, keys)
        held = [batch.slice(cut)]
    if held:
        table = pa.Table.from_batches(held)
        yield table, run_starts(table, keys)


def components(links: DataFrame, name: str) -> DataFrame:
    """``node, label`` for every node of the links ``a, b``: nodes are connected exactly if their labels are equal.

    The label is the smallest node. Every round gives a node the smallest label among its neighbours and then that label's
    own label, so that distances halve; rounds end when no label changes. Rounds are written to the shared folder; neighbours
    are only ever reduced by ``min``, so a node with very many links is summed on the map side.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-links")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = materialize(labels, f"{name}-labels")
    while True:
        told = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "label")
        known = labels.select("node", "label", F.col("label").alias("before"))
        told = told.select("node", "label", F.lit(None).cast(labels.schema["label"].dataType).alias("before"))
        near = known.union(told).groupBy("node").agg(F.min("label").alias("label"), F.max("before").alias("before"))
        of_label = near.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = near.join(of_label, "label").select("node", F.col("further").alias("label"), "before")
        after = materialize(after, f"{name}-labels")
        labels = after.select("node", "label")
        if after.where("label <> before").isEmpty():
            return labels
