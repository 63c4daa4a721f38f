"""Quality rules: how much of a text lies in repeated n-grams and lines.

Method: repetition coverage. Words are hashed once per batch; rolling hashes give every window of several lengths,
and windows and lines that occurred earlier in the same text are found by sorting (text, hash) pairs in numpy. The
measures are the characters inside such windows and lines, so that long repeated stretches count by their size.

Beyond the base rule repetition decides. Symbols are counted; whether too many of them fail a text is for the rules to say, as lists, tables and
source code have many too: by default they do not, ``op9_quality_rules`` sets a limit.

Every text is one row of a map: nothing is shuffled, no text meets another one, memory is bounded by one batch piece
(4 MB of text, or one longer text).

Defined results: a null text has no words; an empty text and one of white space alone have no words and fail the base
rule (fewer than ``MIN_WORDS``). Repeated rows are judged each for itself. Further columns are neither read nor
touched; the id column is passed through with its type, nulls included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tokens import Texts, chunks, mix, running, whole_windows, windows

MIN_WORDS = 20
BASE_WINDOW = 8
BASE_PERCENT = 30
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


@dataclass(frozen=True)
class RepetitionRules:
    """The most, in per cent, that a text may have of each measure.

    ``window_percent``: word characters inside windows of that many words which occurred earlier in the text.
    ``line_percent``: lines equal to an earlier one, of all lines with a word.
    ``line_char_percent``: characters of such lines, of the characters of all lines with a word.
    ``symbol_percent``: symbols per hundred words, for text that repeats one mark after every word; None for any number.
    """

    window_percent: dict[int, int] = field(default_factory=lambda: {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10})
    line_percent: int = 30
    line_char_percent: int = 20
    symbol_percent: int | None = None


MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "line_chars", "dup_line_chars", "n_repeat_words"]


def window_column(length: int) -> str:
    return f"dup_chars_{length}"


def repeated(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries in ascending order: those whose value occurs twice or more in their text, and those that occurred earlier.

    Both as indices. Entries are sorted by one mixed key of text and value; only those of equal keys are looked at again.
    """
    if len(value) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        key = value ^ mix(text.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    member = np.zeros(len(key), bool)
    member[1:] |= same
    member[:-1] |= same
    at, value_at = order[member], ordered[member]
    if not len(at):
        return at, at
    again = np.lexsort((at, value_at))
    at, value_at = at[again], value_at[again]
    later = np.concatenate([[False], value_at[1:] == value_at[:-1]])
    return at, at[later]


def covered(starts: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """The words that lie in a window of this length at one of the starts."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def measures(texts: Texts, lengths: list[int]) -> dict[str, np.ndarray]:
    """All measures of each text."""
    words = texts.words()
    chars = texts.code_points(words.starts, words.ends)
    of_words = words.texts()

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.diff(running(values)[words.offsets])

    out = {"n_words": words.per_text, "word_chars": per_text(chars), "n_symbols": texts.per_text(_SYMBOL[texts.data])}

    starts, ends, first_line = texts.lines()
    words_before = np.searchsorted(words.starts, np.stack([starts, ends]))
    filled = np.flatnonzero(words_before[1] > words_before[0])
    starts, ends = starts[filled], ends[filled]
    line_text = np.searchsorted(first_line, filled, "right") - 1
    line_chars = texts.code_points(starts, ends)
    _, later = repeated(line_text, texts.hashes(starts, ends))
    n = len(texts)
    out["n_lines"] = np.bincount(line_text, minlength=n)
    out["n_dup_lines"] = np.bincount(line_text[later], minlength=n)
    out["line_chars"] = np.bincount(line_text, line_chars, n).astype(np.int64)
    out["dup_line_chars"] = np.bincount(line_text[later], line_chars[later], n).astype(np.int64)

    for length, hashes in windows(words.hash, sorted({*lengths, BASE_WINDOW})):
        at = whole_windows(words, length)
        twice, later = repeated(of_words[at], hashes[at])
        if length == BASE_WINDOW:
            out["n_repeat_words"] = per_text(covered(at[twice], length, len(chars)))
        if length in lengths:
            out[window_column(length)] = per_text(np.where(covered(at[later], length, len(chars)), chars, 0))
    return out


def measure_repetition(docs: DataFrame, lengths: list[int], id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: its id and the measures, as longs; with ``carry`` also the row itself as the struct ``row``."""
    names = [*MEASURES, *map(window_column, sorted(lengths))]
    every = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    rows = docs.select(F.col(id_col).alias("id"), *every, F.col(text_col).cast("string").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema if f.name != "text"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            found = measures(texts, lengths)
            counted = [pa.array(found[name].astype(np.int64)) for name in names]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counted], [*kinds, *names])

    schema = ", ".join([*(f"{name} {kind}" for name, kind in kinds.items()), *(f"{name} bigint" for name in names)])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def quality_rules(
    docs: DataFrame,
    rules: RepetitionRules = RepetitionRules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """The measures of each document with ``base_failed`` and ``kept``.

    All limits are compared in whole numbers (``100 * part > percent * whole``), so no rounding decides.
    """
    found = measure_repetition(docs, list(rules.window_percent), id_col, text_col, carry)
    over = (F.lit(100) * F.col("n_dup_lines") > F.lit(rules.line_percent) * F.col("n_lines")) | (
        F.lit(100) * F.col("dup_line_chars") > F.lit(rules.line_char_percent) * F.col("line_chars")
    )
    if rules.symbol_percent is not None:
        over = over | (F.lit(100) * F.col("n_symbols") > F.lit(rules.symbol_percent) * F.col("n_words"))
    for length, percent in rules.window_percent.items():
        over = over | (F.lit(100) * F.col(window_column(length)) > F.lit(percent) * F.col("word_chars"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(BASE_PERCENT) * F.col("n_words"))
    return found.withColumn("base_failed", base_failed).withColumn("kept", ~(base_failed | over))


def keep_good(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    return quality_rules(docs, rules, id_col, text_col, carry=True).where("kept").select("row.*")
