"""Periodic runs of words by online dyadic square catching.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring word extends and that is
at least ``exponent`` periods and ``least`` words long; ``exponent`` is at least 2, so every run holds a square.

``Catchers`` reads words in the order in which they are appended. Every completed block of B = 2^k words has a catcher that waits for the
block to come again at a distance of 2B to 4B - 1 words (distance 1 has blocks of one word). A window of q >= 2B words holds such a block whole,
so a square of any period meets a catcher. Per level two catchers are awake for the suffix that ends at an appended word, and the
suffix is compared with both by a rolling code. Catches of one distance by neighbouring blocks are squares of one run and merge; the
merged stretch grows by less than a block on either side, word by word. A catch inside a known run whose period divides its distance is
no news and is dropped, so texts of one repeated word give no more work than others. Blocks are found by code, but what is reported is compared word for
word (by the 64-bit codes of the words). Work is O(n log n) for n words; appended words are handled as arrays, and any
split into appends gives the same runs.

Texts: a null or empty text has no words and no runs. Every row is judged by its own text, so repeated rows give repeated results. Texts are
read whole, in slices of some megabytes; a longer text is a slice of its own and takes about 100 bytes a word. Columns named like a made one
(n_words, runs, collapsed) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketloom.llm.words import BASE, BASE_INVERSE, Words, slices, widened

EXPONENT = 4
LEAST = 6
APPEND = 1 << 16
MADE = ("n_words", "runs", "collapsed")
RUNS = "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Catchers:
    """Runs of an appended stream of word codes; ``begin`` tells for each word where its text starts in the stream."""

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 2:
            raise ValueError("runs of less than two periods hold no square")
        self.exponent, self.least = exponent, least
        self.n = 0
        self.codes = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # of code * BASE^i
        self.down = np.ones(1, np.uint64)  # BASE^-i
        self.reach = np.zeros(0, np.int64)  # end of the farthest run over a word, and that run's period
        self.period = np.ones(0, np.int64)
        self.open: dict[tuple[int, bool], np.ndarray] = {}  # level -> rows (distance, first block, last block)
        self.found: list[tuple[int, int, int]] = []

    def append(self, codes: np.ndarray, begin: np.ndarray) -> None:
        """Append words; for long arrays in parts, so that temporary arrays stay small."""
        for at in range(0, len(codes), APPEND):
            self._append(codes[at : at + APPEND], begin[at : at + APPEND])

    def _append(self, codes: np.ndarray, begin: np.ndarray) -> None:
        old, new = self.n, self.n + len(codes)
        self._grow(codes, begin)
        deepest = int((np.arange(old, new) - begin).max()) + 1 if len(codes) else 0
        self._level(old, 1, single=True)
        block = 1
        while 3 * block <= deepest or (block, False) in self.open:
            self._level(old, block)
            block *= 2

    def _grow(self, codes: np.ndarray, begin: np.ndarray) -> None:
        old, new = self.n, self.n + len(codes)
        if new > len(self.codes):
            room = max(new, 2 * len(self.codes))

            def wider(x: np.ndarray, size: int, fill: int) -> np.ndarray:
                out = np.full(size, fill, x.dtype)
                out[: len(x)] = x
                return out

            self.codes, self.begin = wider(self.codes, room, 0), wider(self.begin, room, 0)
            self.reach, self.period = wider(self.reach, room, 0), wider(self.period, room, 1)
            self.sums, self.down = wider(self.sums, room + 1, 0), wider(self.down, room + 1, 1)
        up = np.full(len(codes) + 1, BASE, np.uint64)
        down = np.full(len(codes) + 1, BASE_INVERSE, np.uint64)
        up[0] = np.uint64(pow(int(BASE), old, 1 << 64))
        down[0] = np.uint64(pow(int(BASE_INVERSE), old, 1 << 64))
        self.down[old : new + 1] = np.multiply.accumulate(down)
        self.codes[old:new], self.begin[old:new] = codes, begin
        self.sums[old + 1 : new + 1] = self.sums[old] + np.cumsum(codes * np.multiply.accumulate(up)[:-1])
        self.n = new

    def _code(self, at: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.down[at]

    def _level(self, old: int, block: int, single: bool = False) -> None:
        """Catch the suffixes that end at the words from ``old`` on, and settle the stretches that cannot grow any more."""
        at = np.arange(max(old - block + 1, 0), self.n - block + 1)
        text = self.begin[at + block - 1]
        near = 1 if single else 2 * block
        deep = at - text >= near
        at, text = at[deep], text[deep]
        code = self._code(at, block)
        caught = [self.open.pop((block, single), np.zeros((0, 3), np.int64))]
        for step in range(1 if single else 2):
            catcher = at - 1 if single else ((at - near) // block - step) * block
            awake = np.flatnonzero(catcher >= text)
            i, b = at[awake], catcher[awake]
            hit = self._code(b, block) == code[awake]
            i, b = i[hit], b[hit]
            news = (self.reach[b] < i + block) | ((i - b) % self.period[b] != 0)
            i, b = i[news], b[news]
            caught.append(np.stack([i - b, b, b], 1))
        rows = np.concatenate(caught)
        if len(rows):
            self._settle(self._merge(rows, block), block, single)

    @staticmethod
    def _merge(rows: np.ndarray, block: int) -> np.ndarray:
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] > rows[:-1, 2] + block)
        first = np.flatnonzero(new)
        return np.stack([rows[first, 0], rows[first, 1], rows[np.append(first[1:], len(rows)) - 1, 2]], 1)

    def _settle(self, rows: np.ndarray, block: int, single: bool, done: bool = False) -> None:
        distance, first, last = rows.T
        ended = self._text_end(first) < self.n
        closed = ended | (last + 2 * block + distance <= self.n) | done
        if not closed.all():
            self.open[(block, single)] = rows[~closed]
        wanted = np.maximum(self.least, self.exponent * distance)
        for i in np.flatnonzero(last - first + 3 * block - 2 + distance >= wanted):
            self._stretch(int(distance[i]), int(first[i]), int(last[i]), block, bool(closed[i]))

    def _text_end(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin[: self.n], self.begin[at], "right")

    def _stretch(self, q: int, first: int, last: int, block: int, closed: bool) -> None:
        """Compare the words around caught blocks one by one, and keep the runs among them."""
        low = max(first - block + 1, int(self.begin[first]))
        high = min(last + 2 * block - 1, int(self._text_end(np.array([first]))[0]) - q)
        equal = np.zeros(high - low + 2, np.int8)
        equal[1:-1] = self.codes[low:high] == self.codes[low + q : high + q]
        turn = np.diff(equal)
        for start, end in zip(np.flatnonzero(turn == 1) + low, np.flatnonzero(turn == -1) + low + q):
            if end - start >= max(self.least, self.exponent * q):
                part = slice(start, end)
                better = self.reach[part] < end
                self.reach[part][better] = end
                self.period[part][better] = q
                if closed:
                    self.found.append((int(start), int(end), q))

    def runs(self) -> np.ndarray:
        """Rows (start, end, period) of all runs, in the order of start, then period; ends the stream."""
        for (block, single), rows in list(self.open.items()):
            self._settle(rows, block, single, done=True)
        self.open.clear()
        if not self.found:
            return np.zeros((0, 3), np.int64)
        rows = np.array(self.found, np.int64)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)  # one stretch has one smallest period
        new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        rows = rows[new]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    at = np.flatnonzero(keep)
    text = words.text[at]
    length = words.end[at] - words.start[at] + 1
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(at) else 0
    source = np.repeat(words.start[at] - (ends - length), length) + np.arange(total)
    space = ends - 1
    source[space] = 0
    out = words.data[source] if total else np.zeros(0, np.uint8)
    out[space] = 0x20
    last = np.flatnonzero(np.append(text[1:] != text[:-1], True)) if len(at) else at
    whole = np.ones(total, bool)
    whole[space[last]] = False
    out = out[whole]
    sizes = np.bincount(text, weights=length, minlength=words.texts).astype(np.int64)
    sizes[text[last]] -= 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.Array.from_buffers(pa.large_string(), words.texts, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())


def _of_slice(rows: pa.RecordBatch, exponent: int, least: int) -> list[pa.Array]:
    words = Words(rows.column("text"))
    catchers = Catchers(exponent, least)
    catchers.append(words.codes(), words.first[:-1][words.text])
    start, end, period = catchers.runs().T
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    first = np.searchsorted(start, words.first)
    text = words.text[start] if len(start) else start
    items = pa.StructArray.from_arrays(
        [pa.array(start - words.first[text]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
    )
    return [
        pa.array(words.counts, pa.int64()),
        pa.ListArray.from_arrays(pa.array(first, pa.int32()), items),
        joined(words, np.cumsum(gone)[:-1] == 0),
    ]


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``docs`` without texts, with ``n_words``, ``runs`` (start and length in words, period) and ``collapsed``, the words that no run
    holds behind its first period, joined by one space."""
    if exponent < 2:
        raise ValueError("runs of less than two periods hold no square")
    kept = docs.drop("text", *MADE)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            made = _of_slice(rows, exponent, least)
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in names] + made, names=[*names, *MADE])

    return docs.select(*names, "text").mapInArrow(run, widened(kept.schema.fields, RUNS))
