"""Benchmark decontamination by spaced-seed hashing.

A mask marks some positions of a short window. Hashing only the marked words lets a window of a benchmark item meet its
copy in a document although words at the other positions were replaced. Masked window hashes of both sides are
joined, and around each hit document and item are laid against each other on the hit's diagonal: the item
counts as leaked where a stretch of ``STRETCH`` neighbouring words (the whole item if it is shorter) agrees in
``AGREE_PERCENT`` of them or more. The four masks find every stretch of 13 words with up to two replaced; items of 10 to 12
words have two more masks of fewer words, so that any two of theirs may be replaced as well. Items shorter than that are
hashed whole and leak where all their words follow each other.

Words are compared with ASCII letters in lower case and ASCII punctuation left out; a word of punctuation alone vanishes.
In scripts without spaces (Han, kana, Thai, Lao, Khmer, Myanmar) every character is a word, and the punctuation of Han is left out.

Scale. Nearly all windows of a corpus meet no benchmark. Every item window sets two bits of a filter of fixed
size (``FILTER_BITS``, 8 MB whatever the benchmark); the filter is broadcast and only windows that pass leave the map, as
regions of words around the hits. A larger benchmark passes more windows and costs more shuffle, but no result
depends on the filter. Hits meet items in an equi-join; a leaked item that a third of all documents hold is a skewed key
of narrow rows against a few item rows, which adaptive joins split. Equal items are searched once. A whole item is one hit
per document however often it is there, and its row carries no words. Masks and lengths that no item needs are not hashed.

Defined results: null and empty texts and items hold no words and match nothing. Items of fewer than ``shortest`` words are not
searched; at 1, as in the query and the pipeline, all are, and an item of one common word is found in every document with that
word. A document's last place of a whole item is reported. Of equal items the smallest id is reported with their number.
Repeated documents (same id, same text) give the same rows once. Empty tables on either side give an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tokens import WORD_BASE, Texts, Words, chunks, mix, running
from tallyline.session import materialize

MASKS = ("1101101101", "1110101011", "1100101111", "1011110011")
#: Besides these, for items shorter than ``STRETCH``: any two of 10, 11 or 12 words may be replaced.
SHORT_MASKS = ("111011", "11000111")
STRETCH = 13
AGREE_PERCENT = 80
SHORTEST = 5
FILTER_BITS = 1 << 26
#: Of some hundred bytes each in a task's memory.
BROADCAST_LEAKS = 100_000

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


#: First bytes of characters in scripts without spaces, and of Han punctuation.
_NO_SPACES = np.zeros(256, bool)
_NO_SPACES[[0xE0, 0xE1, 0xE2, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True


def apart(texts: Texts) -> Texts:
    """The texts with spaces around every character of a script without spaces and in place of Han punctuation."""
    data = texts.data
    if not _NO_SPACES[data].any():
        return texts
    second, third = np.append(data[1:], 0)[: len(data)], np.append(data[2:], [0, 0])[: len(data)]

    def follows(lead: int, low: int, high: int) -> np.ndarray:
        return (data == lead) & (second >= low) & (second <= high)

    marks = follows(0xE3, 0x80, 0x80) & ((third < 0x85) | (third > 0x87))
    marks |= follows(0xEF, 0xBC, 0xBC) & ((third <= 0x8F) | ((third >= 0x9A) & (third <= 0xA0)))
    letters = follows(0xE0, 0xB8, 0xBB) | follows(0xE1, 0x80, 0x81) | follows(0xE1, 0x9E, 0x9F) | follows(0xE2, 0xBA, 0xBF)
    letters |= (data >= 0xE3) & (data <= 0xE9) | follows(0xEF, 0xA4, 0xAB) | follows(0xF0, 0xA0, 0xB3)
    letters = np.flatnonzero(letters & ~marks)
    gap = np.zeros(len(data) + 1, bool)
    gap[letters] = True
    gap[letters + np.where(data[letters] == 0xF0, 4, 3)] = True
    gap = gap[:-1]
    out = np.full(len(data) + gap.sum(), 0x20, np.uint8)
    place = np.arange(len(data)) + np.cumsum(gap)
    out[place] = data
    for at in range(3):
        out[place[np.flatnonzero(marks) + at]] = 0x20
    return Texts(out, texts.offsets + running(gap)[texts.offsets])


def plain_words(texts: Texts) -> Words:
    return apart(texts.without(_PUNCTUATION[texts.data])).lower_ascii().words()


@dataclass(frozen=True)
class Kind:
    """A way to hash windows, for items of ``low`` to ``high`` words; a whole item is its own window."""

    number: int
    mask: str
    low: int
    high: float
    whole: bool


def kinds_of(masks: tuple[str, ...], stretch: int) -> list[Kind]:
    span = max(map(len, masks))
    found = [(mask, len(mask), float("inf"), False) for mask in masks]
    found += [(mask, span, stretch - 1, False) for mask in SHORT_MASKS]
    found += [("1" * length, length, length, True) for length in range(1, span)]
    return [Kind(number, *rest) for number, rest in enumerate(found)]


def masked_windows(words: Words, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every whole window under the mask."""
    span = len(mask)
    count = np.maximum(words.per_text - span + 1, 0)
    starts = np.repeat(words.offsets[:-1] - running(count)[:-1], count) + np.arange(count.sum())
    total, power = np.full(len(starts), number + 1, np.uint64), np.uint64(1)
    for at, mark in enumerate(mask):
        power = np.uint64(int(power) * int(WORD_BASE) & 0xFFFFFFFFFFFFFFFF)
        if mark == "1":
            total += words.hash[starts + at] * power
    return starts, mix(total)


def filter_bits(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a filter of this size (a power of two) that stand for a hash."""
    mask = np.uint64(size - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, kinds: list[Kind], shortest: int) -> DataFrame:
    """Per distinct item: key, smallest id, number of equal items, word hashes, masked window hashes with positions."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            words = plain_words(texts)
            found = []
            for kind in kinds:
                at, value = masked_windows(words, kind.mask, kind.number)
                size = words.per_text[np.searchsorted(words.offsets, at, "right") - 1]
                wanted = (size >= kind.low) & (size <= kind.high)
                found.append((at[wanted], value[wanted]))
            starts = np.concatenate([x[0] for x in found]).astype(np.int64)
            hashes = np.concatenate([x[1] for x in found]).view(np.int64)
            of = np.searchsorted(words.offsets, starts, "right") - 1
            order = np.argsort(of, kind="stable")
            edges = pa.array(np.searchsorted(of[order], np.arange(len(texts) + 1)).astype(np.int32))
            ends = pa.array(words.offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(ends, pa.array(words.hash.view(np.int64))),
                    pa.ListArray.from_arrays(edges, pa.array(hashes[order])),
                    pa.ListArray.from_arrays(edges, pa.array((starts - words.offsets[of])[order].astype(np.int32))),
                ],
                ["item_id", "words", "hashes", "places"],
            )

    schema = "item_id bigint, words array<bigint>, hashes array<bigint>, places array<int>"
    made = rows.mapInArrow(run, schema).where((F.size("hashes") > 0) & (F.size("words") >= shortest))
    made = made.withColumn("item", F.md5(F.to_json(F.struct("words"))))
    once = ("words", "hashes", "places")
    return made.groupBy("item").agg(
        F.min("item_id").alias("item_id"), F.count("*").alias("n_items"), *(F.first(c).alias(c) for c in once)
    )


def build_filter(items: DataFrame, size: int) -> np.ndarray:
    """The filter's bytes: set bits are combined in Spark, at most size / 64 words of it come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            bits = np.unique(np.concatenate(filter_bits(hashes, size)))
            word, first = np.unique(bits >> 6, return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (bits & 63).astype(np.uint64), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], ["word", "bits"])

    set_bits = items.select(F.explode("hashes").alias("hash")).mapInArrow(run, "word bigint, bits bigint")
    table = np.zeros(size // 64, np.uint64)
    for row in set_bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        table[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return table.view(np.uint8)


def last_of_each(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The last of the windows of each text that have the same hash, for windows in order of place."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    last = np.ones(len(order), bool)
    last[:-1] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return order[last]


def hit_regions(docs: DataFrame, filter_bytes: np.ndarray, kinds: list[Kind], margin: int) -> DataFrame:
    """Stretches of documents around windows that pass the filter, with those windows' hashes and places.

    A window as long as a whole item is a row of its own without words, at its place.
    """
    size = len(filter_bytes) * 8
    shared = docs.sparkSession.sparkContext.broadcast(filter_bytes)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    span = max(len(kind.mask) for kind in kinds)
    names = ["doc_id", "doc", "region", "words", "hashes", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch, texts in chunks(batches, "text"):
            words = plain_words(texts)
            starts, hashes = [], []
            for kind in kinds:
                at, value = masked_windows(words, kind.mask, kind.number)
                one, two = filter_bits(value, size)
                passed = np.flatnonzero(table[one >> 3] >> (one & 7).astype(np.uint8) & 1)
                two = two[passed]
                passed = passed[(table[two >> 3] >> (two & 7).astype(np.uint8) & 1).astype(bool)]
                at, value = at[passed], value[passed]
                if not kind.whole:
                    starts.append(at)
                    hashes.append(value)
                    continue
                text = np.searchsorted(words.offsets, at, "right") - 1
                once = last_of_each(text, value)
                at, value, text = at[once], value[once], text[once]
                if len(at):
                    ones = pa.array(np.arange(len(at) + 1).astype(np.int32))
                    none = pa.array(np.zeros(len(at) + 1, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(text)),
                            batch.column(1).take(pa.array(text)),
                            pa.array((at - words.offsets[text]).astype(np.int64)),
                            pa.ListArray.from_arrays(none, pa.array(np.zeros(0, np.int64))),
                            pa.ListArray.from_arrays(ones, pa.array(value.view(np.int64))),
                            pa.ListArray.from_arrays(ones, pa.array(np.zeros(len(at), np.int32))),
                        ],
                        names,
                    )
            start, value = np.concatenate(starts), np.concatenate(hashes)
            if not len(start):
                continue
            order = np.argsort(start, kind="stable")
            start, value = start[order], value[order]
            text = np.searchsorted(words.offsets, start, "right") - 1
            low = np.maximum(start - margin, words.offsets[text])
            high = np.minimum(start + span + margin, words.offsets[text + 1])
            # hits come in order of place, so a region ends where the next hit's surroundings begin after it
            new = np.concatenate([[True], (text[1:] != text[:-1]) | (low[1:] > np.maximum.accumulate(high)[:-1])])
            head = np.flatnonzero(new)
            low, high = low[head], np.maximum.reduceat(high, head)
            edges = pa.array(np.append(head, len(start)).astype(np.int32))
            lengths = high - low
            inside = np.repeat(low - running(lengths)[:-1], lengths) + np.arange(lengths.sum())
            region = np.cumsum(new) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(text[head])),
                    batch.column(1).take(pa.array(text[head])),
                    pa.array((low - words.offsets[text[head]]).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(running(lengths).astype(np.int32)), pa.array(words.hash[inside].view(np.int64))),
                    pa.ListArray.from_arrays(edges, pa.array(value.view(np.int64))),
                    pa.ListArray.from_arrays(edges, pa.array((start - low[region]).astype(np.int32))),
                ],
                names,
            )

    columns = "doc string, region bigint, words array<bigint>, hashes array<bigint>, places array<int>"
    return docs.select("doc_id", "doc", "text").mapInArrow(run, f"doc_id {id_kind}, {columns}")


def verify(pairs: DataFrame, stretch: int, percent: int) -> DataFrame:
    """Adds ``matched``, ``first_word`` and ``n_words`` of the aligned stretches that agree well enough; 0 where none does."""
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    kept = [c for c in pairs.columns if c not in ("words", "item_words", "diagonal", "region")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {name: batch.column(batch.schema.get_field_index(name)) for name in ("words", "item_words", "diagonal", "region")}
            out = np.zeros((3, batch.num_rows), np.int64)
            for i in range(batch.num_rows):
                item = table["item_words"][i].values.to_numpy()
                text = table["words"][i].values.to_numpy()
                shift = table["diagonal"][i].as_py()
                low, high = max(0, -shift), min(len(item), len(text) - shift)
                need = min(stretch, len(item))
                if high - low < need:
                    continue
                equal = item[low:high] == text[low + shift : high + shift]
                sums = running(equal)
                good = np.flatnonzero(100 * (sums[need:] - sums[:-need]) >= percent * need)
                if len(good):
                    first, last = good[0], good[-1] + need
                    out[:, i] = sums[last] - sums[first], table["region"][i].as_py() + low + shift + first, last - first
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *map(pa.array, out)], [*kept, "matched", "first_word", "n_words"])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in kept), "matched bigint", "first_word bigint", "n_words bigint"])
    return pairs.mapInArrow(run, schema)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    stretch: int = STRETCH,
    percent: int = AGREE_PERCENT,
    filter_size: int = FILTER_BITS,
    shortest: int = SHORTEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each document and item it leaks: ``doc_id, doc, item_id, n_items, matched, first_word, n_words``.

    ``doc`` is the digest of the text, ``matched`` the equal words of the best diagonal, ``first_word`` and ``n_words`` its
    place in the document.
    """
    kinds = kinds_of(masks, stretch)
    items = materialize(item_windows(benchmark, item_col, item_text_col, kinds, shortest), "benchmark-windows")
    short = {row[0] for row in items.select(F.size("words").alias("n")).where(F.col("n") < stretch).distinct().collect()}
    kinds = [kind for kind in kinds if kind.high >= stretch or any(kind.low <= n <= kind.high for n in short)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.md5(text).alias("doc"))
    regions = materialize(hit_regions(rows, build_filter(items, filter_size), kinds, 2 * stretch), "leak-regions")
    whole = any(kind.whole for kind in kinds)

    def spread(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.select(*keys, F.explode(F.arrays_zip("hashes", "places")).alias("hit")).select(
            *keys, F.col("hit.hashes").alias("hash"), F.col("hit.places").alias("place")
        )

    hits = spread(regions.where(F.size("words") > 0), "doc_id", "doc", "region").alias("h").join(spread(items, "item").alias("i"), "hash")
    diagonal = (F.col("h.place") - F.col("i.place")).alias("diagonal")
    pairs = hits.select("doc_id", "doc", "region", "item", diagonal).distinct().alias("p")
    same = F.col("p.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("p.doc") == F.col("r.doc")) & (F.col("p.region") == F.col("r.region"))
    words = regions.where(F.size("words") > 0).select("doc_id", "doc", "region", "words").dropDuplicates(["doc_id", "doc", "region"]).alias("r")
    pairs = pairs.join(words, same).select("p.*", "r.words")
    pairs = pairs.join(items.select("item", "item_id", "n_items", F.col("words").alias("item_words")), "item")
    found = verify(pairs, stretch, percent).where("matched > 0")
    found = found.select("doc_id", "doc", "item", "item_id", "n_items", "matched", "first_word", "n_words")
    if whole:
        places = regions.where(F.size("words") == 0).select("doc_id", "doc", "region", F.col("hashes")[0].alias("hash"))
        length = F.size("words").cast("long")
        own = items.where(F.size("hashes") == 1).select(F.col("hashes")[0].alias("hash"), "item", "item_id", "n_items", length.alias("length"))
        exact = places.join(own, "hash")
        found = found.union(exact.select("doc_id", "doc", "item", "item_id", "n_items", "length", "region", "length"))
    best = F.max(F.struct("matched", "first_word", "n_words")).alias("best")
    found = found.groupBy("doc_id", "doc", "item").agg(F.first("item_id").alias("item_id"), F.first("n_items").alias("n_items"), best)
    return found.select("doc_id", "doc", "item_id", "n_items", "best.*")


def drop_leaked(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that leak an item, all columns and repeated rows kept.

    Up to ``BROADCAST_LEAKS`` leaking documents, counted first, are sent to every task, so that no text is shuffled for their sake; more
    are joined by a shuffle.
    """
    text = F.md5(F.coalesce(F.col(f"d.{text_col}").cast("string"), F.lit("")))
    bad = leaks.select(F.col("doc_id").alias("leak_id"), F.col("doc").alias("leak_doc")).distinct()
    bad = materialize(bad, "leaking-docs")
    if bad.count() <= BROADCAST_LEAKS:
        bad = F.broadcast(bad)
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("leak_id")) & (text == F.col("leak_doc"))
    return docs.alias("d").join(bad, same, "left_anti")
