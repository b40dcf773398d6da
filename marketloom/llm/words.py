"""Words of whole UTF-8 texts as arrays, so that tasks work on some megabytes of text at a time and not word by word.

The word classes used here are defined on ASCII characters, and every byte of a longer UTF-8 sequence is at least 0x80, so
cutting bytes cuts the same words as cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 2 << 20
HASH_WORDS = 1 << 16

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
GRAM_BASE = 0xD6E8FEB86659FD93

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = True
ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts in ``column`` hold about ``size`` bytes; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.concatenate([[0], np.cumsum(lengths)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(run, run[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """Words of the texts of a column: byte bounds ``start`` and ``end``, and ``first``, the first word of each text."""

    def __init__(self, column: pa.Array, word: np.ndarray = NOT_SPACE, lower: bool = False):
        data, offsets = text_bytes(column)
        self.data = LOWER[data] if lower else data
        inside = word[self.data]
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[1:], before[0] = inside[:-1], False
            after[:-1], after[-1] = inside[1:], False
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            before[edges] = False
            after[edges - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.texts = len(offsets) - 1

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(self.texts), self.counts)

    def codes(self, most_bytes: int | None = None) -> np.ndarray:
        """A 64-bit code of each word, or of its first ``most_bytes`` bytes."""
        out = np.empty(len(self), np.uint64)
        for lo in range(0, len(self), HASH_WORDS):
            hi = min(lo + HASH_WORDS, len(self))
            base = self.start[lo]
            start, end = self.start[lo:hi] - base, self.end[lo:hi] - base
            values = BYTE_VALUES[self.data[base : self.end[hi - 1]]]
            up = np.full(len(values) + 1, BASE, np.uint64)
            down = np.full(len(values) + 1, BASE_INVERSE, np.uint64)
            up[0] = down[0] = 1
            values *= np.multiply.accumulate(up)[:-1]
            run = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values, out=run[1:])
            if most_bytes is not None:
                end = np.minimum(end, start + most_bytes)
            out[lo:hi] = (run[end] - run[start]) * np.multiply.accumulate(down)[start]
        return mix(out)

    def room(self, words: int) -> np.ndarray:
        """Whether a run of ``words`` words that starts at a word stays inside its text."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return left >= words


def grams(codes: np.ndarray, words: int, base: int = GRAM_BASE) -> np.ndarray:
    """A code of each run of ``words`` words, by doubling; the last runs, cut short by the end, mean nothing."""
    out = np.zeros(len(codes), np.uint64)
    done, power, step, length = 0, codes, pow(base, 1, 1 << 64), 1
    factor = 1
    rest = words
    while rest:
        if rest & 1:
            out[: len(codes) - done] += power[done:] * np.uint64(factor) if done < len(codes) else 0
            done += length
            factor = factor * step % (1 << 64)
        rest >>= 1
        if rest:
            shifted = np.zeros(len(codes), np.uint64)
            shifted[: max(len(codes) - length, 0)] = power[length:]
            power = power + shifted * np.uint64(step)
            length *= 2
            step = step * step % (1 << 64)
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def widened(fields: list[StructField], more: str) -> StructType:
    """A schema of ``fields`` and the columns of a DDL string."""
    return StructType(list(fields) + StructType.fromDDL(more).fields)
