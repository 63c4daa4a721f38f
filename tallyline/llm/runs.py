"""Periodic runs: stretches of consecutive words that repeat with a period, by maximal-pair enumeration.

A run is a stretch with smallest period q and a length of at least ``max(MIN_LENGTH, 2 * q)`` that no neighbouring word
extends with that period.

Method. The suffixes of a text are put in order by prefix doubling, which also gives their longest common prefixes (LCP). The tree
of LCP intervals is walked bottom-up; a node keeps its positions in one list per left word. Where two children of a node
meet, positions with different left words are a maximal pair: equal for exactly the node's LCP, extendable to neither side. A
maximal pair at distance q whose LCP is at least q and at least ``MIN_LENGTH - q`` is exactly a run of length q + LCP, so no pair is
extended afterwards. A multiple of a run's period gives the same stretch; the smallest distance of a stretch is its period.

Only nodes with an LCP of ``MIN_LENGTH / 2`` or more can hold such a pair. Of the subtrees below that depth, those
whose positions all have the same left word (the inner phases of a run), or lie further apart than their deepest LCP, hold
none and are not walked. Within a run the occurrences of a node's word sequence have one left word, but for the first, and
the lists of left words let the search skip them, so a text that is one single run of n words costs n log n steps.

Scale. A map over documents, nothing is shuffled. Texts are handled in batches of 2 MB, or one longer text alone; memory is some 100
bytes per word of a batch.

Defined results: a null text has no words, hence no runs and an empty collapsed text; so has an empty one. Ids may be null or
repeated, every row is judged for itself. Extra columns are not read. An empty table gives an empty result. Words are told apart by
64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.quality import repeated
from tallyline.llm.tokens import Texts, Words, chunks, running, whole_windows, windows

MIN_LENGTH = 12


def suffix_order(word: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in the order of their suffixes, text by text, and the ranks after each doubling.

    ``start`` and ``end`` bound the text of each position. Rank k is equal for two positions exactly if the next 2**k
    words are equal and within their texts.
    """
    n = len(word)
    order = np.lexsort((word, start))
    new = np.ones(n, bool)
    new[1:] = (word[order[1:]] != word[order[:-1]]) | (start[order[1:]] != start[order[:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, length = [rank], 1
    while not new.all():
        open_slot = ~new
        open_slot[:-1] |= ~new[1:]
        slots = np.flatnonzero(open_slot)
        at = order[slots]
        after = at + length
        second = np.where(after < end[at], rank[np.minimum(after, n - 1)], -1)
        key = rank[at].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[slots] = at[by]
        changed = np.ones(len(slots), bool)
        changed[1:] = key[1:] != key[:-1]
        new[slots] = changed
        rank = rank.copy()
        rank[order[slots]] = np.maximum.accumulate(np.where(changed, slots, 0))
        levels.append(rank)
        length *= 2
    return order, levels


def common_prefixes(first: np.ndarray, second: np.ndarray, end: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at two positions of a text have in common, by halving steps over the ranks."""
    a, b = first.copy(), second.copy()
    end_a, end_b = end[first], end[second]
    last = len(end) - 1
    for level in reversed(range(len(levels))):
        rank = levels[level]
        equal = (a < end_a) & (b < end_b) & (rank[np.minimum(a, last)] == rank[np.minimum(b, last)])
        a[equal] += 1 << level
        b[equal] += 1 << level
    return a - first


class Node:
    """Positions below a node of the LCP-interval tree, all in order and per left word."""

    __slots__ = ("every", "by_left")

    def __init__(self, position: int, left: int):
        self.every = [position]
        self.by_left = {left: [position]}

    def others(self, left: int, low: int, high: int) -> Iterator[int]:
        """Positions in [low, high] with another left word. Stretches of the same left word are skipped by halving."""
        every, own = self.every, self.by_left.get(left, [])
        open_parts = [(bisect_left(every, low), bisect_right(every, high), bisect_left(own, low), bisect_right(own, high))]
        while open_parts:
            a, b, c, d = open_parts.pop()
            if b - a == d - c:
                continue
            if c == d:
                yield from every[a:b]
                continue
            middle = (a + b) // 2
            cut = bisect_left(own, every[middle], c, d)
            open_parts += [(a, middle, c, cut), (middle, b, cut, d)]

    def add(self, other: Node) -> None:
        for position in other.every:
            insort(self.every, position)
        for left, positions in other.by_left.items():
            mine = self.by_left.setdefault(left, [])
            for position in positions:
                insort(mine, position)


def _meet(one: Node, two: Node, lcp: int, least: int, found: list[tuple[int, int, int]]) -> Node:
    """Report the maximal pairs between two children of a node, then join the smaller to the larger."""
    large, small = (one, two) if len(one.every) >= len(two.every) else (two, one)
    nearest = max(1, least - lcp)
    for left, positions in small.by_left.items():
        for position in positions:
            for partner in large.others(left, position - lcp, position - nearest):
                found.append((partner, position - partner, lcp))
            for partner in large.others(left, position + nearest, position + lcp):
                found.append((position, partner - position, lcp))
    large.add(small)
    return large


def maximal_pairs(positions: list[int], lcps: list[int], lefts: list[int], least: int) -> list[tuple[int, int, int]]:
    """Bottom-up over the LCP intervals of positions in suffix order: ``(start, distance, LCP)`` of the pairs that are runs.

    ``lcps[k]`` belongs to the positions k and k + 1.
    """
    found: list[tuple[int, int, int]] = []
    open_nodes: list[tuple[int, Node]] = []
    node = Node(positions[0], lefts[0])
    for k, lcp in enumerate(lcps):
        while open_nodes and open_nodes[-1][0] > lcp:
            depth, before = open_nodes.pop()
            node = _meet(before, node, depth, least, found)
        if open_nodes and open_nodes[-1][0] == lcp:
            node = _meet(open_nodes.pop()[1], node, lcp, least, found)
        open_nodes.append((lcp, node))
        node = Node(positions[k + 1], lefts[k + 1])
    while open_nodes:
        depth, before = open_nodes.pop()
        node = _meet(before, node, depth, least, found)
    return found


def _suspects(words: Words, shortest: int) -> np.ndarray:
    """Texts in which a window of ``shortest`` words occurs twice; no other text has a run."""
    ((_, hashes),) = windows(words.hash, [shortest])
    at = whole_windows(words, shortest)
    twice, _ = repeated(words.texts()[at], hashes[at])
    return np.unique(words.texts()[at[twice]])


def runs_of(words: Words, min_length: int = MIN_LENGTH) -> np.ndarray:
    """The runs of all texts as rows ``text, start, length, period`` in this order; starts are word numbers in the text."""
    shortest = max(1, (min_length + 1) // 2)
    none = np.zeros((0, 4), np.int64)
    texts = _suspects(words, shortest)
    if not len(texts):
        return none
    sizes = words.per_text[texts]
    offsets = running(sizes)
    at = np.repeat(words.offsets[texts] - offsets[:-1], sizes) + np.arange(offsets[-1])
    _, word = np.unique(words.hash[at], return_inverse=True)
    start, end = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    order, levels = suffix_order(word, start, end)

    # neighbours in suffix order with enough in common, as stretches of rows
    depth = min(len(levels), shortest.bit_length()) - 1
    equal = np.flatnonzero(levels[depth][order[1:]] == levels[depth][order[:-1]])
    lcp = common_prefixes(order[equal], order[equal + 1], end, levels)
    equal, lcp = equal[lcp >= shortest], lcp[lcp >= shortest]
    if not len(equal):
        return none
    first = np.ones(len(equal), bool)
    first[1:] = equal[1:] != equal[:-1] + 1
    cut = np.flatnonzero(first)
    pairs = np.diff(np.append(cut, len(equal)))

    # positions of every stretch: one more than its neighbour pairs
    members = np.repeat(equal[cut] - running(pairs + 1)[:-1], pairs + 1) + np.arange(len(equal) + len(cut))
    stretch = np.repeat(np.arange(len(cut)), pairs + 1)
    position = order[members]
    left = np.where(position > start[position], word[position - 1], -1)
    heads = running(pairs + 1)[:-1]
    varied = np.maximum.reduceat(left, heads) != np.minimum.reduceat(left, heads)
    sorted_rows = np.lexsort((position, stretch))
    gap = np.full(len(position), np.iinfo(np.int64).max)
    gap[1:] = np.where(stretch[sorted_rows[1:]] == stretch[sorted_rows[:-1]], np.diff(position[sorted_rows]), gap[0])
    near = np.minimum.reduceat(gap, heads) <= np.maximum.reduceat(lcp, cut)

    found: list[tuple[int, int, int]] = []
    for k in np.flatnonzero(varied & near):
        low, high = heads[k], heads[k] + pairs[k] + 1
        found += maximal_pairs(
            position[low:high].tolist(), lcp[cut[k] : cut[k] + pairs[k]].tolist(), left[low:high].tolist(), min_length
        )
    if not found:
        return none
    begin, period, common = np.array(found, np.int64).T
    length = period + common
    by = np.lexsort((period, length, begin))
    begin, length, period = begin[by], length[by], period[by]
    smallest = np.ones(len(by), bool)
    smallest[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, length, period = begin[smallest], length[smallest], period[smallest]
    text = np.searchsorted(offsets, begin, "right") - 1
    rows = np.stack([texts[text], begin - offsets[text], length, period], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def dropped_words(words: Words, runs: np.ndarray) -> np.ndarray:
    """The words that a run contains after its first period."""
    edge = np.zeros(len(words.hash) + 1, np.int64)
    first = words.offsets[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, first + runs[:, 3], 1)
    np.add.at(edge, first + runs[:, 2], -1)
    return np.cumsum(edge[:-1]) > 0


def joined(texts: Texts, words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of every text with one space between them, as an Arrow array of strings."""
    kept = np.flatnonzero(keep)
    per_text = np.diff(running(keep)[words.offsets])
    sizes = words.ends[kept] - words.starts[kept]
    last = np.cumsum(per_text) - 1
    sizes = sizes + 1
    sizes[last[per_text > 0]] -= 1  # no space after the last word
    offsets = running(sizes)
    source = np.repeat(words.starts[kept] - offsets[:-1], sizes) + np.arange(offsets[-1])
    inside = np.ones(offsets[-1], bool)
    spaces = np.ones(len(kept), bool)
    spaces[last[per_text > 0]] = False
    inside[offsets[1:][spaces] - 1] = False
    data = np.where(inside, texts.data[np.minimum(source, max(len(texts.data) - 1, 0))], 0x20) if len(source) else source
    ends = offsets[running(per_text)].astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.astype(np.uint8).tobytes()))


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_words``, ``runs`` as an array of ``start, length, period`` by start, then period, and
    ``collapsed``, the text without the words that repeat a run's first period, joined by single spaces."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            words = texts.words()
            found = runs_of(words, min_length)
            ends = np.searchsorted(found[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(words.per_text.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), spans),
                    joined(texts, words, ~dropped_words(words, found)),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    schema = f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
