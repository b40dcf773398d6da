"""Benchmark decontamination over a positional inverted index.

``build_index`` writes the training corpus as index segments, each made from one run of whole texts: for every term that
the benchmark holds, the sorted positions at which it occurs, and for every text its key and its word count. ``phrases`` turns
benchmark items into windows of ``width`` consecutive words. ``search`` brings the postings of a segment together and starts,
for every window at once, from the postings of the window's rarest term in the segment; each further term, in order of rarity,
keeps the starts whose offset-adjusted position is in its list, so what is left are exact phrase matches. ``near`` uses the
same postings for stretches of at most ``width`` words that hold all terms of an item in any order.

A segment holds a bounded number of bytes of text (a longer text is one segment), so no group grows with the corpus. The
benchmark is taken in blocks of bounded size, each searched in all segments; its matches are united per document.

Nulls: a null text has no words; an item without words matches nothing; an item of fewer than ``width`` words is one window.
A null item_id counts as an item and is written as an empty string. Rows that agree in doc_id and text are one document and
all get its result. Two different words with equal 64-bit codes would be taken for one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from marketloom.llm.words import ALPHANUMERIC, Words, signed, slices, widened
from marketloom.session import cut_lineage

WINDOW = 13
BLOCK_BYTES = 4 << 20
SEGMENT_BYTES = 8 << 20
INDEX = (
    "segment string, term long, positions binary, keys array<long>, ids array<long>, starts array<int>, words array<long>"
)
MATCHES = "key long, starts array<int>, ends array<int>, items array<string>"


class Phrases:
    """Windows of benchmark items as rows of term numbers (-1 beyond the end of a short one), each with its items."""

    def __init__(self, items: list[Row], width: int = WINDOW):
        words = Words(pa.array([r["text"] for r in items], pa.string()), ALPHANUMERIC, lower=True)
        self.terms, number = np.unique(words.codes(), return_inverse=True)
        self.items = ["" if r["item_id"] is None else str(r["item_id"]) for r in items]
        self.item_terms = [np.unique(number[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
        seen: dict[bytes, int] = {}
        rows, self.item_of = [], []
        for item, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            for at in range(a, max(b - width, a) + 1 if b > a else a):
                row = np.full(width, -1, np.int64)
                row[: min(width, b - at)] = number[at : min(at + width, b)]
                key = seen.setdefault(row.tobytes(), len(rows))
                if key == len(rows):
                    rows.append(row)
                    self.item_of.append([])
                if item not in self.item_of[key]:
                    self.item_of[key].append(item)
        self.windows = np.array(rows, np.int64).reshape(len(rows), width)
        self.lengths = (self.windows >= 0).sum(1)


def blocks(benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Phrases]:
    """The benchmark's windows, in blocks of items of about ``block_bytes`` of text chosen by a hash."""
    found = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = found.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = -(-int(size) // block_bytes)
    for part in range(parts):
        block = Phrases(found.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect(), width)
        if len(block.windows):
            yield block


def build_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """The written index of the texts of ``docs`` for ``terms`` (sorted codes): one row per segment and term, and one of
    its texts, whose term is null. Positions leave a gap of one between texts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # at most one block of the benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        present = np.zeros(1 << 20, bool)
        present[(wanted & np.uint64(0xFFFFF)).astype(np.int64)] = True
        schema = pa.schema(
            [
                ("segment", pa.string()),
                ("term", pa.int64()),
                ("positions", pa.binary()),
                ("keys", pa.list_(pa.int64())),
                ("ids", pa.list_(pa.int64())),
                ("starts", pa.list_(pa.int32())),
                ("words", pa.list_(pa.int64())),
            ]
        )
        for rows in slices(batches, "text", SEGMENT_BYTES):
            words = Words(rows.column("text"), ALPHANUMERIC, lower=True)
            code = words.codes()
            at = np.flatnonzero(present[(code & np.uint64(0xFFFFF)).astype(np.int64)])
            term = np.minimum(np.searchsorted(wanted, code[at]), max(len(wanted) - 1, 0))
            hit = wanted[term] == code[at] if len(wanted) else np.zeros(0, bool)
            at, term = at[hit], term[hit]
            position = (at + words.text[at]).astype(np.int32)
            order = np.argsort(term, kind="stable")
            term, position = term[order], position[order]
            cuts = np.flatnonzero(np.diff(term, prepend=-1))
            lists = [p.tobytes() for p in np.split(position, cuts[1:])] if len(cuts) else []
            n = len(lists)
            starts = (words.first[:-1] + np.arange(words.texts)).astype(np.int32)
            one = lambda values, kind: pa.array([None] * n + [values], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex] * (n + 1)),
                    pa.array([int(t) for t in signed(wanted[term[cuts]])] + [None], pa.int64()),
                    pa.array(lists + [None], pa.binary()),
                    one(rows.column("key").to_pylist(), pa.int64()),
                    one(rows.column("doc_id").to_pylist(), pa.int64()),
                    one(starts, pa.int32()),
                    one(words.counts, pa.int64()),
                ],
                schema=schema,
            )

    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut_lineage(keyed.mapInArrow(run, INDEX))


class Segment:
    """The postings of one segment, as one sorted array of (term number, position)."""

    def __init__(self, rows: pa.Table, terms: np.ndarray):
        code = rows.column("term").fill_null(0).to_numpy()
        texts = rows.column("term").is_null().to_numpy()
        head = rows.filter(pa.array(texts))
        self.keys, self.starts = head.column("keys")[0].as_py(), np.array(head.column("starts")[0].as_py(), np.int64)
        self.counts = np.array(head.column("words")[0].as_py(), np.int64)
        lists = [np.frombuffer(b, np.int32) for b in rows.filter(pa.array(~texts)).column("positions").to_pylist()]
        number = np.searchsorted(terms, code[~texts].astype(np.int64).view(np.uint64))
        order = np.argsort(number)
        self.sizes = np.zeros(len(terms) + 1, np.int64)
        self.sizes[number] = [len(x) for x in lists]
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes[:-1])])
        self.flat = np.concatenate([lists[i] for i in order]).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.postings = (np.repeat(np.arange(len(terms)), self.sizes[:-1]) << 32) | self.flat

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each position is in the list of its term."""
        key = (term << 32) | position
        at = np.minimum(np.searchsorted(self.postings, key), max(len(self.postings) - 1, 0))
        return (self.postings[at] == key) & (position >= 0) if len(self.postings) else np.zeros(len(key), bool)

    def text(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, "right") - 1


AT_ONCE = 1 << 20


def exact(segment: Segment, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every exact occurrence, by intersecting offset-adjusted lists from the rarest term on."""
    sizes = np.where(phrases.windows >= 0, segment.sizes[phrases.windows], 1 << 40)
    alive = np.flatnonzero(sizes.min(1) > 0) if len(sizes) else np.zeros(0, np.int64)
    order = np.argsort(sizes[alive], axis=1, kind="stable")
    term = np.take_along_axis(phrases.windows[alive], order, 1)
    lengths = sizes[alive].min(1) if len(alive) else np.zeros(0, np.int64)
    windows, found = [], []
    run = np.cumsum(lengths)
    lo = 0
    while lo < len(alive):
        hi = max(lo + 1, int(np.searchsorted(run, (run[lo - 1] if lo else 0) + AT_ONCE, "right")))
        span = lengths[lo:hi]
        row = np.repeat(np.arange(lo, hi), span)
        within = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        start = segment.flat[segment.offsets[term[row, 0]] + within] - order[row, 0]
        for j in range(1, phrases.windows.shape[1]):
            keep = (term[row, j] < 0) | segment.holds(term[row, j], start + order[row, j])
            row, start = row[keep], start[keep]
        windows.append(alive[row])
        found.append(start)
        lo = hi
    none = np.zeros(0, np.int64)
    return (np.concatenate(windows), np.concatenate(found)) if windows else (none, none)


def proximate(segment: Segment, phrases: Phrases, width: int) -> Iterator[tuple[int, int, int]]:
    """(item, first, last position) of the stretches of at most ``width`` words that hold all terms of an item, each
    starting with one of them and as short as can be from there."""
    for item, terms in enumerate(phrases.item_terms):
        if not len(terms) or not segment.sizes[terms].all():
            continue
        lists = sorted((segment.flat[segment.offsets[t] : segment.offsets[t] + segment.sizes[t]] for t in terms), key=len)
        near = np.unique(np.concatenate([x[np.searchsorted(lists[0], x - width) < np.searchsorted(lists[0], x + width)] for x in lists]))
        last = near.copy()
        for x in lists:
            place = np.searchsorted(x, near)
            following = np.where(place < len(x), x[np.minimum(place, len(x) - 1)], 1 << 40)
            last = np.maximum(last, following)
        good = last - near < width
        first, last = near[good], last[good]
        good = segment.text(first) == segment.text(last)
        yield from ((item, int(a), int(b)) for a, b in zip(first[good], last[good]))


def search(index: DataFrame, phrases: Phrases, near: int | None = None) -> DataFrame:
    """(key, starts, ends, items) of the texts with matches: word ranges and the items that match there.

    Exact occurrences of windows, or, with ``near``, stretches of at most that many words with all terms of an item.
    """
    shared = index.sparkSession.sparkContext.broadcast(phrases)  # at most one block of the benchmark

    def run(rows: pa.Table) -> pa.Table:
        wanted: Phrases = shared.value
        segment = Segment(rows, wanted.terms)
        if near is None:
            window, start = exact(segment, wanted)
            end = start + wanted.lengths[window]
            items = [wanted.item_of[w] for w in window]
        else:
            found = np.array(list(proximate(segment, wanted, near)), np.int64).reshape(-1, 3)
            start, end, items = found[:, 1], found[:, 2] + 1, [[i] for i in found[:, 0]]
        text = segment.text(start)
        order = np.lexsort((start, text))
        cuts = np.flatnonzero(np.diff(text[order], prepend=-1))
        groups = np.split(order, cuts[1:]) if len(cuts) else []
        base = segment.starts
        return pa.table(
            {
                "key": pa.array([segment.keys[text[g[0]]] for g in groups], pa.int64()),
                "starts": pa.array([(start[g] - base[text[g[0]]]).tolist() for g in groups], pa.list_(pa.int32())),
                "ends": pa.array([(end[g] - base[text[g[0]]]).tolist() for g in groups], pa.list_(pa.int32())),
                "items": pa.array([sorted({wanted.items[i] for r in g for i in items[r]}) for g in groups], pa.list_(pa.string())),
            }
        )

    return index.groupBy("segment").applyInArrow(run, MATCHES)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit, items, digest = [], [], []
        for parts in batch.column("found").to_pylist():
            names = sorted({i for p in parts or [] for i in p["items"]})
            spans = sorted((a, b) for p in parts or [] for a, b in zip(p["starts"], p["ends"]))
            total = reached = 0
            for a, b in spans:
                total += max(0, b - max(a, reached))
                reached = max(reached, b)
            hit.append(total)
            items.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(hit, pa.int64()), pa.array(items, pa.int64()), pa.array(digest, pa.string())],
            names=[*batch.schema.names, "n_hit", "n_items", "items_sha256"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document: doc_id, key, n_words, n_hit (words inside a benchmark window), n_items, items_sha256, contaminated."""
    texts = matches = None
    for phrases in blocks(benchmark, width):
        index = build_index(docs, phrases.terms)
        texts = index if texts is None else texts
        found = search(index, phrases)
        matches = found if matches is None else matches.unionByName(found)
    if texts is None:
        texts = build_index(docs, np.zeros(0, np.uint64))
        matches = docs.sparkSession.createDataFrame([], MATCHES)
    heads = (
        texts.where(F.col("term").isNull())
        .select(F.explode(F.arrays_zip("keys", "ids", "words")).alias("t"))
        .select(F.col("t.ids").alias("doc_id"), F.col("t.keys").alias("key"), F.col("t.words").alias("n_words"))
    )
    # equal rows and several blocks of the benchmark give a key more than one row of matches
    per_key = matches.groupBy("key").agg(F.collect_set(F.struct("starts", "ends", "items")).alias("found"))
    joined = heads.join(per_key, "key", "left")
    return (
        joined.mapInArrow(_united, widened(joined.schema.fields, "n_hit long, n_items long, items_sha256 string"))
        .drop("found")
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )
