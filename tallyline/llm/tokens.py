"""Words, lines and rolling hashes of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
In UTF-8 these bytes occur only as themselves, so words are found on the bytes of an Arrow column without
decoding it and without a loop over documents or words.

Hashes are polynomials modulo 2**64 whose prefix sums give the hash of any stretch in constant time, mixed by a
final permutation. Two different stretches agree with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = np.uint64(0xD1B54A32D192ED03)
CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd number modulo 2**64."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


@dataclass
class Texts:
    """Texts laid end to end: document i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower_ascii(self) -> Texts:
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(np.where(upper, self.data | 32, self.data).astype(np.uint8), self.offsets)

    def without(self, flags: np.ndarray) -> Texts:
        """The texts without the flagged bytes."""
        return Texts(self.data[~flags], running(~flags)[self.offsets])

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        return np.diff(running(flags)[self.offsets])

    def words(self, space: np.ndarray = SPACE) -> Words:
        """The maximal runs of bytes that ``space`` does not flag."""
        inside = ~space[self.data]
        first, last = inside.copy(), inside.copy()
        if len(inside):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            heads = self.offsets[:-1][self.offsets[:-1] < len(inside)]
            first[heads] = inside[heads]
            tails = self.offsets[1:][self.offsets[1:] > 0] - 1
            last[tails] = inside[tails]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return Words(starts, ends, np.searchsorted(starts, self.offsets), self.hashes(starts, ends))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each stretch of bytes."""
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(BYTE_BASE, len(self.data)), out=total[1:])
        inverse = _powers(pow(BYTE_BASE, -1, 1 << 64), len(self.data) + 1)
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def code_points(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        heads = running((self.data & 0xC0) != 0x80)
        return heads[ends] - heads[starts]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every line, split at line feeds, and the first line of each text with the total."""
        breaks = np.flatnonzero(self.data == 0x0A)
        starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.offsets[1:], breaks]), kind="stable")
        per_text = np.diff(np.searchsorted(breaks, self.offsets)) + 1
        return starts, ends, np.concatenate([[0], np.cumsum(per_text)])


@dataclass
class Words:
    """Words of texts: those of text i are ``[offsets[i], offsets[i + 1])``."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hash: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.offsets)

    def texts(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.per_text)


def running(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values."""
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def windows(word_hash: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each length in ascending order, the hash of the window that starts at each word.

    The hash of a longer window is that of a shorter one plus one product. Windows run over the ends of texts;
    the caller leaves those out.
    """
    total, power, done = np.zeros(len(word_hash), np.uint64), np.uint64(1), 0
    for length in sorted(lengths):
        while done < length:
            kept = max(len(word_hash) - done, 0)
            with np.errstate(over="ignore"):
                total = total[:kept] + word_hash[done:] * power
                power = power * WORD_BASE
            done += 1
        yield length, mix(total)


def whole_windows(words: Words, length: int) -> np.ndarray:
    """The words at which a window of this length starts that ends in the same text."""
    count = np.maximum(words.per_text - length + 1, 0)
    first = np.repeat(words.offsets[:-1] - running(count)[:-1], count)
    return first + np.arange(count.sum())


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The texts of an Arrow string column, a null as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(column) else Texts(data[:0], np.zeros(1, np.int64))


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Pieces of the batches whose texts hold at most ``limit`` bytes, or one text alone if it is longer."""
    for batch in batches:
        texts = texts_of(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < len(texts):
            to = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(texts))
            low, high = texts.offsets[at], texts.offsets[to]
            yield batch.slice(at, to - at), Texts(texts.data[low:high], texts.offsets[at : to + 1] - low)
            at = to
