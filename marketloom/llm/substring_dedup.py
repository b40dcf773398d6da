"""Removal of passages that occur more than once, by level-wise doubling of window lengths.

A window is ``WINDOW`` consecutive words. The first level takes windows of a quarter of that length; in every long window
the one with the smallest code stands for it, so two equal long windows have it at the same place and the others need not
be looked at. Codes that occur once alone drop out. What is left is extended to twice the length, on the side where the long
window must reach, and counted again; the last level doubles to the full length, for all long windows that a survivor stands for. A word is
removed if a window that is repeated at the last level covers it.

Equal texts are one class: every one of its windows is repeated if the class has two rows, and the class takes part in the
counting of all others once. Only the texts that hold a survivor of the first level travel, and each of them once per level. A code that occurs very
often is only ever counted; its rows are joined with one row of counts, a join that splits hot keys.

Words are compared by 64-bit codes and windows by 64-bit codes of them: among c candidate windows, c * c / 2^65 unequal pairs are
expected to be taken for equal.

Nulls: a null text has no words. A document shorter than a window loses nothing. Rows that repeat a text, with or without
their doc_id, count as several documents, so a repeated row of 35 words or more is removed in whole. Overlapping repeats inside one document count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.keyfilter import maybe_among
from marketloom.llm.words import Words, grams, mix, signed, slices
from marketloom.session import cut_lineage

WINDOW = 35
CODES = "code long, doc long, twice boolean"
NOTHING = hashlib.sha256(b"").hexdigest()


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over values[i : i + width]; beyond the end over what is there."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        longer = out.copy()
        if step < len(out):
            best(out[:-step], out[step:], out=longer[:-step])
        out, have = longer, have + step
    return out


class Levels:
    """Window codes of the texts of a column at the three lengths."""

    def __init__(self, column: pa.Array, window: int):
        self.window = window
        self.lengths = (-(-window // 4), -(-window // 2))
        self.words = Words(column)
        self.codes = self.words.codes()
        self.full = self.words.room(window)
        short = self.lengths[0]
        self.short = grams(self.codes, short)
        reach = window - short + 1
        least = _sliding(self.short, reach, np.minimum)
        self.least = np.where(self.full, least, np.uint64(0))
        # the smallest code of some full window that holds it: its own code is the largest of those minima
        padded = np.concatenate([np.zeros(reach - 1, np.uint64), self.least])
        self.anchor = (_sliding(padded, reach, np.maximum)[: len(self.short)] == self.short) & (self.short != 0) & self.words.room(short)

    def extensions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, position of the extension, its code) of both doubled windows of each anchor, inside their text."""
        short, half = self.lengths
        code = grams(self.codes, half)
        room = self.words.room(half)
        at = np.flatnonzero(self.anchor)
        left = at - (half - short)
        inside = left >= np.repeat(self.words.first[:-1], self.words.counts)[at] if len(at) else np.zeros(0, bool)
        where = np.concatenate([at, at[inside]])
        begin = np.concatenate([at, left[inside]])
        keep = room[begin]
        return where[keep], begin[keep], mix(code[begin[keep]])

    def windows(self) -> np.ndarray:
        return grams(self.codes, self.window)


def _distinct(text: np.ndarray, code: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, whether it is at two places of the text)."""
    order = np.lexsort((place, code, text))
    text, code, place = text[order], code[order], place[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(text)) - 1
    return text[at], code[at], place[last] != place[at] if len(at) else np.zeros(0, bool)


def _rows(docs: pa.Array, text: np.ndarray, code: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    text, code, twice = _distinct(text, code, place)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(code)), docs.take(pa.array(text)), pa.array(twice)], names=["code", "doc", "twice"]
    )


def _members(lists: pa.Array, text: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether each code is in its text's list."""
    spans = np.diff(np.asarray(lists.offsets))
    own = np.repeat(np.arange(len(lists)), spans).astype(np.uint64)
    held = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    pair = lambda t, c: mix(c ^ mix(t.astype(np.uint64)))
    return np.isin(pair(text, code), pair(own, held))


def _per_text(make: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            yield make(rows)

    return run


def survivors(codes: DataFrame, name: str) -> DataFrame:
    """(doc, ``name``): for each document its codes that occur at another place too."""
    repeated = (
        codes.groupBy("code")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("twice").alias("twice"))
        .where((F.col("low") != F.col("high")) | F.col("twice"))
        .select("code")
    )
    return codes.select("code", "doc").join(repeated, "code").groupBy("doc").agg(F.collect_set("code").alias(name))


def first_level(window: int) -> Callable:
    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        levels = Levels(rows.column("text"), window)
        at = np.flatnonzero(levels.anchor)
        return _rows(rows.column("doc"), levels.words.text[at], levels.short[at], at)

    return make


def second_level(window: int) -> Callable:
    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        levels = Levels(rows.column("text"), window)
        where, begin, code = levels.extensions()
        text = levels.words.text[where]
        keep = _members(rows.column("first"), text, levels.short[where])
        return _rows(rows.column("doc"), text[keep], code[keep], begin[keep])

    return make


def _candidates(rows: pa.RecordBatch, window: int) -> tuple[Levels, np.ndarray]:
    """Starts of the full windows that a survivor of the second level stands for."""
    levels = Levels(rows.column("text"), window)
    where, _, code = levels.extensions()
    text = levels.words.text
    alive = np.unique(where[_members(rows.column("second"), text[where], code)])
    pair = lambda t, c: mix(c ^ mix(t.astype(np.uint64)))
    start = np.flatnonzero(levels.full)
    return levels, start[np.isin(pair(text[start], levels.least[start]), pair(text[alive], levels.short[alive]))]


def third_level(window: int) -> Callable:
    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        levels, start = _candidates(rows, window)
        return _rows(rows.column("doc"), levels.words.text[start], levels.windows()[start], start)

    return make


def _kept_texts(words: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    change = np.zeros(len(words.data) + 1, np.int32)
    np.add.at(change, words.start[keep], 1)
    np.add.at(change, words.end[keep], -1)
    out = np.cumsum(change[:-1]) > 0
    data = words.data.copy()
    at = np.flatnonzero(keep)
    text = words.text[at]
    between = at[:-1][text[:-1] == text[1:]]
    out[words.end[between]] = True
    data[words.end[between]] = 0x20
    run = np.concatenate([[0], np.cumsum(out)])
    packed = data[out].tobytes()
    first = np.searchsorted(text, np.arange(words.texts + 1))
    return [
        packed[run[words.start[at[a]]] : run[words.end[at[b - 1]]]] if b > a else b"" for a, b in zip(first[:-1], first[1:])
    ]


def last_step(window: int) -> Callable:
    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        levels, start = _candidates(rows, window)
        words = levels.words
        repeated = start[_members(rows.column("third"), words.text[start], levels.windows()[start])]
        change = np.zeros(len(words) + window + 1, np.int32)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + window, -1)
        gone = np.cumsum(change)[: len(words)] > 0
        removed = np.bincount(words.text[gone], minlength=words.texts) if len(words) else np.zeros(words.texts, np.int64)
        kept = _kept_texts(words, ~gone)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc"),
                pa.array(removed.astype(np.int64)),
                pa.array([k.decode() for k in kept], pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            ],
            names=["doc", "n_removed", "kept_text", "kept_sha256"],
        )

    return make


def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, "text"):
        words = Words(rows.column("text"))
        kept = _kept_texts(words, np.ones(len(words), bool))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("doc"), pa.array(words.counts, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
            names=["doc_id", "doc", "n_words", "whole_sha256"],
        )


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Texts with a repeated window, one row per distinct text: doc (its code), n_removed, kept_text, kept_sha256."""
    keyed = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("doc"), "doc_id", "text")
    first = survivors(keyed.select("doc", "text").mapInArrow(_per_text(first_level(window)), CODES), "first")
    first = cut_lineage(first)
    one = keyed.groupBy("doc").agg(F.min("doc_id").alias("own"))
    wanted = first.join(one, "doc")
    texts = maybe_among(keyed, "doc", first.select("doc"))
    same = (texts["doc"] == wanted["doc"]) & texts["doc_id"].eqNullSafe(wanted["own"])
    held = texts.join(wanted, same).select(texts["doc"], "text", "first")
    held = cut_lineage(held)
    second = survivors(held.mapInArrow(_per_text(second_level(window)), CODES), "second")
    again = cut_lineage(held.drop("first").join(second, "doc"))
    third = survivors(again.mapInArrow(_per_text(third_level(window)), CODES), "third")
    found = again.join(third, "doc").mapInArrow(
        _per_text(last_step(window)), "doc long, n_removed long, kept_text string, kept_sha256 string"
    )
    return found


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("doc"), "text")
    rows = cut_lineage(keyed.mapInArrow(whole_texts, "doc_id long, doc long, n_words long, whole_sha256 string"))
    copies = rows.groupBy("doc").agg(F.count("*").alias("rows"))
    found = repeats(docs, window).select("doc", "n_removed", "kept_sha256").dropDuplicates(["doc"])
    known = copies.join(found, "doc", "left")
    whole = (F.col("rows") > 1) & (F.col("n_words") >= window)
    return rows.join(known, "doc", "left").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
