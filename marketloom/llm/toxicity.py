"""Toxicity by the nearest labelled examples: exact TF-IDF cosine of whole texts, and of the terms that mark toxic examples.

``fit`` takes a bounded sample of labelled rows (``per_class`` of each label, by key hash). Two votes of the ``k`` nearest examples
are taken, and a logistic curve fitted on leave-one-out votes turns both into a probability:

* over whole texts (``Texts``): the vectors hold every word. Document frequencies are counted over *all* documents, those of words
  that no example holds too, as these words are part of a document's norm. Examples lie in blocks, ordered by content. What rare words
  add is summed from posting lists; with the largest weight of each frequent word in a block it bounds the cosines of the block, and
  only blocks whose bound reaches the nearest found so far are multiplied out. The evidence is taken from here.
* over markers (``Examples``): the words and word beginnings that mark toxic examples (by a likelihood ratio). Blocks of examples are
  visited from the highest bound down until none can hold a nearer example. A document that holds no marker is judged here by
  the examples that hold none either.

Nulls: a null text is an empty text; rows without label or key are no examples; without examples of both labels every score is
the toxic share of the examples (0 without any). A text without a word that an example holds has no neighbours.
Rows with one doc_id are scored each by its own text. Ties between equally near examples go to the lower example number.
Other columns are carried along; those named like a column made here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import ALPHANUMERIC, Words, mix, signed, slices, widened
from marketloom.session import cut_lineage

PER_CLASS = 4000
MAX_TERMS = 4096
LEAST_GAIN = 15.0  # likelihood ratio statistic of a term's labels
LEAST_EXAMPLES = 3
PREFIX_BYTES = 5
NEIGHBOURS = 25
BLOCK = 64
NEAR = 0.05
PRIOR = 0.5
FOLDS = 5
COMMON = 12  # a word of more than one in so many examples is a row of the matrix
ROWS = 32  # texts searched together: their postings and products take some 100 MB
FEATURES = "row_id long, toxic int, terms array<long>, counts array<int>, words array<long>, word_counts array<int>"
SEARCHED = ("row_at", "nearest", "product", "square", "odds", "rest", "rest_counts")
MADE = (*SEARCHED, "rest_square", "score", "predicted", "evidence", "held_out")


def fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the key as text, modulo the number of folds; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, term code) of every word, then of the beginning of every longer word; the number of words."""
    words = Words(column, ALPHANUMERIC, lower=True)
    codes, text = words.codes(), words.text
    long = words.end - words.start > PREFIX_BYTES
    prefixes = mix(words.codes(PREFIX_BYTES)[long] ^ np.uint64(0x5DEECE66D))
    return np.concatenate([text, text[long]]), np.concatenate([codes, prefixes]), len(codes)


def counted(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) in the order of text, then term."""
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return text[at], term[at], np.diff(np.append(at, len(text)))


def _lists(text: np.ndarray, values: np.ndarray, texts: int, kind: pa.DataType) -> pa.Array:
    offsets = np.searchsorted(text, np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, "text"):
        texts, terms, words = text_terms(rows.column("text"))
        columns = [rows.column("row_id"), rows.column("toxic")]
        for upto in (len(terms), words):
            text, term, count = counted(texts[:upto], terms[:upto])
            columns += [_lists(text, signed(term), rows.num_rows, pa.int64()), _lists(text, count, rows.num_rows, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["row_id", "toxic", "terms", "counts", "words", "word_counts"])


class Lookup:
    """The place of a code in a sorted list of mixed codes, by open addressing with their upper bits."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.bits = max(4, int(4 * len(codes) + 1).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        waiting = np.arange(len(codes), dtype=np.int32)
        at = self._home(codes)
        while len(waiting):
            free = self.table[at] < 0
            self.table[at[free]] = waiting[free]
            left = self.table[at] != waiting
            waiting, at = waiting[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _home(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code, or -1."""
        out = np.full(len(codes), -1, np.int64)
        at, asked = self._home(codes), np.arange(len(codes))
        while len(asked):
            place = self.table[at]
            some = place >= 0
            asked, at, place = asked[some], at[some], place[some]
            same = self.codes[place] == codes[asked]
            out[asked[same]] = place[same]
            asked, at = asked[~same], (at[~same] + 1) & ((1 << self.bits) - 1)
        return out


def _pairs(text: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, count) in the order of text, then slot."""
    key, count = np.unique((text << 32) | slot, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, count


def read_terms(column: pa.Array, terms: Lookup, vocabulary: Lookup) -> tuple[tuple, tuple, tuple]:
    """(text, slot, count) of the markers, (text, slot, count) of the vocabulary's words and (text, code, count) of all other words."""
    words = Words(column, ALPHANUMERIC, lower=True)
    codes, text = words.codes(), words.text
    long = words.end - words.start > PREFIX_BYTES
    beginning = terms.find(mix(words.codes(PREFIX_BYTES)[long] ^ np.uint64(0x5DEECE66D)))
    whole = terms.find(codes)
    marks = _pairs(
        np.concatenate([text[whole >= 0], text[long][beginning >= 0]]), np.concatenate([whole[whole >= 0], beginning[beginning >= 0]])
    )
    slot = vocabulary.find(codes)
    known = slot >= 0
    return marks, _pairs(text[known], slot[known]), counted(text[~known], codes[~known])


def document_frequencies(docs: DataFrame, terms: np.ndarray, vocabulary: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of rows, rows that hold each marker, rows that hold each word of the vocabulary).

    A task's counts travel in ranges of terms, so many that what meets in one place stays small whatever the number of tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast((terms, vocabulary))
    size = 1 + len(terms) + len(vocabulary)
    ranges = min(size, max(16, docs.rdd.getNumPartitions() // 8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, words = (Lookup(c) for c in shared.value)
        total = np.zeros(size, np.int64)
        for rows in slices(batches, "text"):
            mark, known, _ = read_terms(rows.column("text"), marks, words)
            total[0] += rows.num_rows
            total[1 : 1 + len(marks.codes)] += np.bincount(mark[1], minlength=len(marks.codes))
            total[1 + len(marks.codes) :] += np.bincount(known[1], minlength=len(words.codes))
        parts = np.array_split(total, ranges)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ranges)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def merged(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in rows.column("counts").to_pylist())
        return pa.table({"part": rows.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    kinds = "part long, counts binary"
    found = docs.select("text").mapInArrow(run, kinds).groupBy("part").applyInArrow(merged, kinds).collect()  # one number a term
    shared.destroy()
    total = np.concatenate([np.frombuffer(bytes(r["counts"]), np.int64) for r in sorted(found, key=lambda r: r["part"])] or [np.zeros(size, np.int64)])
    return int(total[0]), total[1 : 1 + len(terms)], total[1 + len(terms) :]


def rest_squares(rows: DataFrame, n_docs: int) -> DataFrame:
    """(row_at, rest_square): what the words outside the vocabulary add to the squares of the rows' norms."""
    each = rows.select("row_at", F.explode(F.arrays_zip("rest", "rest_counts")).alias("v")).select(
        "row_at", F.col("v.rest").alias("term"), F.col("v.rest_counts").alias("n")
    )
    repeated = each.groupBy("term").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    idf = F.log((n_docs + 1) / (F.coalesce("held", F.lit(1)) + 1)) + 1
    return each.join(repeated, "term", "left").groupBy("row_at").agg(F.sum(((1 + F.log("n")) * idf) ** 2).alias("rest_square"))


def vote(cosine: np.ndarray, toxic: np.ndarray, total: np.ndarray, prior: float) -> np.ndarray:
    """Log odds of the distance-weighted votes of the nearest examples."""
    weight = np.where(cosine > 0, 1.0 / (1.0 - cosine + NEAR), 0.0)
    yes = (weight * toxic).sum(1) + PRIOR * prior
    return np.log(yes) - np.log(np.maximum((weight * total).sum(1) + PRIOR - yes, 1e-9))


def visited(product: np.ndarray, upper: np.ndarray, slack: np.ndarray, k: int, multiply, itself=None) -> tuple[np.ndarray, np.ndarray]:
    """Block-max search: (products of each text with the examples of the blocks it visits, the k-th largest of them).

    ``product`` (text x block x place) is what is known before any visit, ``upper`` bounds the products of a block, and
    ``multiply`` gives what a visit of some texts to a block adds. A text visits its most promising blocks first, then all blocks whose bound
    reaches the k-th product found there.
    """
    texts, blocks, _ = product.shape
    width = blocks * BLOCK
    least = np.zeros(texts)
    done = np.zeros((texts, blocks), bool)
    first = min(blocks, -(-k // BLOCK) + 1)
    lead = np.argpartition(-upper, first - 1, axis=1)[:, :first]
    for turn in range(2):
        wanted = np.zeros((texts, blocks), bool)
        if turn == 0:
            np.put_along_axis(wanted, lead, True, 1)
        else:
            wanted = (upper >= (least - slack)[:, None]) & (upper > 0) & ~done
        for block in np.flatnonzero(wanted.any(0)):
            some = np.flatnonzero(wanted[:, block])
            product[some, block] += multiply(some, block)
        done |= wanted
        seen = np.where(done[:, :, None], product, 0.0).reshape(texts, width)
        if itself is not None:
            seen[np.arange(texts), itself] = 0.0
        if width > k:
            least = np.maximum(np.partition(seen, width - k, axis=1)[:, width - k], 0.0)
    return seen, least


@dataclass
class Texts:
    """The examples' whole TF-IDF vectors in blocks: posting lists of rare words, rows of a matrix for the words of many examples, and
    these words' largest weights in each block."""

    idf: np.ndarray
    first: np.ndarray  # of each rare word's list, and the end
    example: np.ndarray
    weight: np.ndarray
    common: np.ndarray  # row in the matrix, or -1
    matrix: np.ndarray  # block x common word x place in the block
    bounds: np.ndarray  # common word x block
    order: np.ndarray  # the example at each place
    toxic: np.ndarray
    total: np.ndarray
    keys: np.ndarray
    prior: float

    @classmethod
    def of(cls, idf, rows, slots, counts, toxic: np.ndarray, weight: np.ndarray, keys: np.ndarray) -> Texts:
        """From the examples' counts, given as (row, slot, count) in row order."""
        n = len(toxic)
        weights = unit_weights(rows, slots, counts, idf) if len(rows) else np.zeros(0)
        often = np.flatnonzero(np.bincount(slots, minlength=len(idf)) * COMMON > n)
        common = np.full(len(idf), -1)
        common[often] = np.arange(len(often))
        # Examples with alike frequent words lie together, so that their blocks' bounds are low.
        held = common[slots] >= 0
        dense = np.zeros((n, len(often)))
        dense[rows[held], common[slots[held]]] = weights[held]
        order = _by_content(dense)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        blocks = -(-n // BLOCK)
        padded = np.zeros((blocks * BLOCK, len(often)))
        padded[:n] = dense[order]
        del dense
        matrix = np.ascontiguousarray(padded.reshape(blocks, BLOCK, len(often)).transpose(0, 2, 1))
        rare = np.flatnonzero(~held)
        rare = rare[np.lexsort((rows[rare], slots[rare]))]
        first = np.searchsorted(slots[rare], np.arange(len(idf) + 1))
        prior = float((weight * toxic).sum() / weight.sum()) if n else 0.0
        return cls(
            idf, first, place[rows[rare]].astype(np.int32), weights[rare], common, matrix, matrix.max(2).T if blocks else np.zeros((len(often), 0)),
            order, weight * toxic, weight, keys, prior,
        )

    def nearest(self, rows, slots, weights, texts: int, k: int, itself=None) -> tuple[np.ndarray, np.ndarray]:
        """(example, product) of the ``k`` nearest of each of ``texts`` vectors; ``itself`` names an example to leave out.

        The nearest do not depend on a vector's length; of unit vectors the products are cosines.
        """
        n, blocks = len(self.toxic), len(self.matrix)
        who, best = np.zeros((texts, k), np.int64), np.full((texts, k), -1.0)
        if not n or not len(rows):
            return who, best
        row = self.common[slots]
        often = row >= 0
        asked = np.zeros((texts, self.bounds.shape[0]))
        asked[rows[often], row[often]] = weights[often]
        length = np.sqrt(np.bincount(rows, weights=weights**2, minlength=texts))
        rows, slots, weights = rows[~often], slots[~often], weights[~often]
        spans = self.first[slots + 1] - self.first[slots]
        ends = np.cumsum(spans)
        pick = np.repeat(self.first[slots] - (ends - spans), spans) + np.arange(ends[-1] if len(ends) else 0)
        width = blocks * BLOCK
        product = np.bincount(
            np.repeat(rows * width, spans) + self.example[pick], np.repeat(weights, spans) * self.weight[pick], texts * width
        ).astype(float).reshape(texts, blocks, BLOCK)  # no weights at all would give integers
        upper = asked @ self.bounds + product.max(2)
        slack = 1e-9 * length
        own = None if itself is None else np.argsort(self.order)[itself]
        seen, least = visited(product, upper, slack, k, lambda some, block: asked[some] @ self.matrix[block], own)
        unit = np.where(length > 0, length, 1.0)
        for i in range(texts):
            place = np.flatnonzero((seen[i, :n] >= least[i] - slack[i]) & (seen[i, :n] > 0))
            near, value = self.order[place], seen[i, place]
            sort = np.lexsort((near, -np.round(value / unit[i], 12)))[:k]
            who[i, : len(sort)], best[i, : len(sort)] = near[sort], value[sort]
        return who, best

    def odds(self, who: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        return vote(cosine, self.toxic[who], self.total[who], self.prior)

    def left_out(self, rows, slots, counts, k: int) -> np.ndarray:
        """Log odds of each example's vote without itself."""
        n = len(self.toxic)
        out = np.zeros(n)
        weights = unit_weights(rows, slots, counts, self.idf) if len(rows) else np.zeros(0)
        for lo in range(0, n, ROWS):
            hi = min(lo + ROWS, n)
            part = slice(*np.searchsorted(rows, (lo, hi)))
            who, cosine = self.nearest(rows[part] - lo, slots[part], weights[part], hi - lo, k, np.arange(lo, hi))
            out[lo:hi] = self.odds(who, np.minimum(cosine, 1.0))
        return out


def _by_content(dense: np.ndarray) -> np.ndarray:
    """An order in which neighbouring rows are alike: halved again and again along the widest of their directions."""
    order = np.arange(len(dense))
    parts = [order]
    while parts and max(map(len, parts)) > BLOCK and dense.shape[1]:
        halves = []
        for part in parts:
            if len(part) <= BLOCK:
                halves.append(part)
                continue
            own = dense[part]
            along = own[:, own.var(0).argmax()]
            sort = part[np.argsort(along, kind="stable")]
            middle = max(BLOCK, len(part) // 2 // BLOCK * BLOCK)
            halves += [sort[:middle], sort[middle:]]
        parts = halves
    return np.concatenate(parts) if parts else order


@dataclass
class Examples:
    """Distinct example vectors in blocks: (block, term) lists of weights, and the largest weight of each list."""

    idf: np.ndarray
    bounds: np.ndarray  # term x block
    blocks: list[tuple[np.ndarray, np.ndarray]]  # terms of the block, terms x slots weights
    toxic: np.ndarray  # weight of toxic examples of each vector
    total: np.ndarray
    keys: np.ndarray
    empty: tuple[float, float, int]
    prior: float
    left_out: np.ndarray | None = None  # log odds of each example's vote without itself

    def nearest(self, rows: np.ndarray, slots: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the ``k`` nearest of each unit vector, given as (row, slot, weight) in row order."""
        n = int(rows[-1]) + 1 if len(rows) else 0
        best, who = np.full((n, k), -1.0), np.full((n, k), -1, np.int64)
        if not n or not self.blocks:
            return who, best
        asked = np.zeros((n, len(self.idf)))
        asked[rows, slots] = weights

        def multiply(some: np.ndarray, block: int) -> np.ndarray:
            terms, lists = self.blocks[block]
            out = np.zeros((len(some), BLOCK))
            out[:, : lists.shape[1]] = asked[np.ix_(some, terms)] @ lists
            return out

        product = np.zeros((n, len(self.blocks), BLOCK))
        seen, least = visited(product, asked @ self.bounds, np.full(n, 1e-9), k, multiply)
        for i in range(n):
            near = np.flatnonzero((seen[i] >= least[i] - 1e-9) & (seen[i] > 0))
            near = near[np.lexsort((near, -np.round(np.minimum(seen[i, near], 1.0), 12)))[:k]]
            who[i, : len(near)], best[i, : len(near)] = near, np.minimum(seen[i, near], 1.0)
        return who, best

    def vote(self, who: np.ndarray, cosine: np.ndarray, less_toxic=0.0, less_total=0.0, itself=None) -> np.ndarray:
        """Log odds of the distance-weighted vote; ``itself`` and the weights to take off serve leave-one-out."""
        toxic, total = self.toxic[who], self.total[who]
        if itself is not None:
            own = who == itself[:, None]
            toxic = np.maximum(toxic - own * less_toxic, 0.0)
            total = np.maximum(total - own * less_total, 0.0)
        return vote(cosine, toxic, total, self.prior)

    def without_terms(self, less_toxic=0.0, less_total=0.0) -> np.ndarray:
        """Log odds among the examples that hold none of the terms."""
        yes = self.empty[0] - less_toxic + PRIOR * self.prior
        return np.log(yes) - np.log(np.maximum(self.empty[1] - less_total + PRIOR - yes, 1e-9))


def unit_weights(rows: np.ndarray, slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights over the norm of each row's vector."""
    weights = (1.0 + np.log(counts)) * idf[slots]
    norm = np.bincount(rows, weights=weights**2)
    return weights / np.sqrt(norm[rows]) if len(rows) else weights


def _curve(odds: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slopes of the columns of ``odds``, none below 0, and offset of the logistic curve through smoothed labels, by Newton steps."""
    start = np.append(np.full(odds.shape[1], 1.0 / max(odds.shape[1], 1)), 0.0)
    yes, no = (weight * toxic).sum(), (weight * (1 - toxic)).sum()
    if yes <= 0 or no <= 0:
        return start
    target = np.where(toxic == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    x = np.concatenate([odds, np.ones((len(odds), 1))], 1)
    beta = start.copy()

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return (weight * (np.logaddexp(0, z) - target * z)).sum() + 0.5e-3 * ((beta - start) ** 2).sum()

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * (beta - start)
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        while loss(beta - step) > loss(beta) and np.abs(step).max() >= 1e-8:
            step /= 2
        if np.abs(step).max() < 1e-8:
            break
        beta = beta - step
    wrong = beta[:-1] <= 0
    if wrong.any():  # a vote that says nothing falls a little when a toxic example is left out
        beta = start * 0.0
        use = np.flatnonzero(~wrong)
        beta[np.append(use, -1)] = _curve(odds[:, use], toxic, weight) if len(use) else np.log(yes / no)
    return beta


def probability(curve: np.ndarray, odds: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(odds @ curve[:-1] + curve[-1], -40, 40)))


def pack(idf: np.ndarray, rows, slots, counts, toxic: np.ndarray, weight: np.ndarray, keys: np.ndarray) -> Examples:
    """Index of labelled vectors given as (row, slot, count) in row order; equal vectors become one with summed labels."""
    n = len(toxic)
    weights = unit_weights(rows, slots, counts, idf) if len(rows) else np.zeros(0)
    first = np.searchsorted(rows, np.arange(n + 1))
    groups: dict[bytes, list[int]] = {}
    for i in range(n):
        a, b = first[i], first[i + 1]
        groups.setdefault(slots[a:b].astype(np.int32).tobytes() + np.round(weights[a:b], 9).tobytes(), []).append(i)
    members = [g for key, g in sorted(groups.items(), key=lambda x: (slots[first[x[1][0]] : first[x[1][0]] + 4].tolist(), x[0])) if key]
    nothing = groups.get(b"", [])
    prior = float((weight * toxic).sum() / weight.sum()) if n else 0.0
    total = np.array([weight[g].sum() for g in members])
    yes = np.array([(weight[g] * toxic[g]).sum() for g in members])
    bounds = np.zeros((len(idf), -(-len(members) // BLOCK)))
    blocks = []
    for b in range(bounds.shape[1]):
        part = [g[0] for g in members[b * BLOCK : (b + 1) * BLOCK]]
        terms = np.unique(np.concatenate([slots[first[i] : first[i + 1]] for i in part]))
        lists = np.zeros((len(terms), len(part)))
        for j, i in enumerate(part):
            lists[np.searchsorted(terms, slots[first[i] : first[i + 1]]), j] = weights[first[i] : first[i + 1]]
        bounds[terms, b] = lists.max(1)
        blocks.append((terms, lists))
    empty = (float((weight[nothing] * toxic[nothing]).sum()), float(weight[nothing].sum()), int(keys[nothing[0]]) if nothing else -1)
    index = Examples(idf, bounds, blocks, yes, total, np.array([keys[g[0]] for g in members], np.int64), empty, prior)
    index.left_out = np.zeros(n)
    if nothing and 0 < prior < 1:
        index.left_out[nothing] = index.without_terms((weight * toxic)[nothing], weight[nothing])
    if members:
        group_of = np.full(n, -1)
        for j, g in enumerate(members):
            group_of[g] = j
        for lo in range(0, n, ROWS):  # few at a time, as this runs on the driver
            part = np.arange(lo, min(lo + ROWS, n))
            part = part[group_of[part] >= 0]
            if not len(part):
                continue
            spans = first[part + 1] - first[part]
            pick = np.concatenate([np.arange(first[i], first[i + 1]) for i in part])
            who, cosine = index.nearest(np.repeat(np.arange(len(part)), spans), slots[pick], weights[pick], NEIGHBOURS)
            index.left_out[part] = index.vote(who, cosine, (weight * toxic)[part][:, None], weight[part][:, None], group_of[part])
    return index


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_terms: int = MAX_TERMS) -> tuple[np.ndarray, DataFrame]:
    """(marker codes, at most ``max_terms``; the vectors of at most 2 * ``per_class`` examples, with all their words)."""
    rated = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold() != 0))
        .groupBy(F.col("doc_id").alias("row_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("row_id")).distinct()
    of_class = lambda t: rated.join(known, "row_id", "left_semi").where(F.col("toxic") == t)
    first = lambda t: of_class(t).orderBy(F.xxhash64("row_id"), "row_id").limit(per_class)
    sample = cut_lineage(first(0).unionByName(first(1)))
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("row_id"), "text")
    vectors = cut_lineage(
        texts.join(F.broadcast(sample), "row_id")  # at most 2 * per_class rows of two integers
        .select("row_id", "toxic", "text")
        .mapInArrow(_example_terms, FEATURES)
    )
    sizes = {r["toxic"]: r["count"] for r in vectors.groupBy("toxic").count().collect()}
    n, yes = sum(sizes.values()), sizes.get(1, 0)
    if not yes or yes == n:
        return np.zeros(0, np.uint64), vectors
    held = vectors.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("t")
    )
    share = F.lit(yes / n)
    clean = F.col("n") - F.col("t")
    gain = 2 * (
        F.col("t") * F.log(F.col("t") / (F.col("n") * share))
        + F.when(clean > 0, clean * F.log(clean / (F.col("n") * (1 - share)))).otherwise(0.0)
    )
    chosen = (
        held.where((F.col("t") >= LEAST_EXAMPLES) & (F.col("t") > F.col("n") * share))
        .withColumn("gain", gain)
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "term")
        .limit(max_terms)
    )
    return np.sort(np.array([r["term"] for r in chosen.select("term").collect()], np.int64).view(np.uint64)), vectors


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` without texts, plus held_out, score, predicted and evidence (nearest examples with cosine and votes)."""
    spark = docs.sparkSession
    terms, vectors = fit(docs, labels, per_class)
    examples = vectors.select("row_id", "toxic", "words", "word_counts").toArrow()  # at most 2 * per_class texts' words
    ids, place = np.unique(examples.column("row_id").to_numpy(), return_inverse=True)
    toxic = np.zeros(len(ids))
    toxic[place] = examples.column("toxic").to_numpy()
    vocabulary = np.unique(_flat(examples, "words").view(np.uint64))
    n_docs, held_marks, held_words = document_frequencies(docs, terms, vocabulary)
    idf = lambda held: np.log((n_docs + 1) / (held + 1)) + 1

    def ordered(at: np.ndarray, slot: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, slot, count) of the examples in row order; of texts with one id the largest count."""
        order = np.lexsort((-n, slot, at))
        at, slot, n = at[order], slot[order], n[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (slot[1:] != slot[:-1])
        return at[new], slot[new], n[new]

    spans = np.diff(np.asarray(examples.column("words").combine_chunks().offsets))
    words = ordered(
        np.repeat(place.astype(np.int32), spans),
        np.searchsorted(vocabulary, _flat(examples, "words").view(np.uint64)).astype(np.int32),
        _flat(examples, "word_counts"),
    )
    del examples
    wanted = spark.createDataFrame([(int(t), i) for i, t in enumerate(signed(terms))], "term long, slot int")
    found = (
        vectors.select("row_id", F.explode(F.arrays_zip("terms", "counts")).alias("v"))
        .select("row_id", F.col("v.terms").alias("term"), F.col("v.counts").alias("n"))
        .join(F.broadcast(wanted), "term")  # at most max_terms rows
        .select("row_id", "slot", "n")
        .toArrow()
    )
    marks = ordered(np.searchsorted(ids, found.column("row_id").to_numpy()), *[found.column(c).to_numpy().astype(np.int64) for c in ("slot", "n")])
    totals = {r["toxic"]: r["count"] for r in labels.where(F.col("toxic").isin(0, 1) & (fold() != 0)).groupBy("toxic").count().collect()}
    share = {t: totals.get(t, 0) / max((toxic == t).sum(), 1) for t in (0, 1)}
    weight = np.where(toxic == 1, share[1], share[0])
    markers = pack(idf(held_marks), *marks, toxic, weight, ids)
    whole = Texts.of(idf(held_words), *words, toxic, weight, ids)
    curve = None
    if 0 < markers.prior < 1:
        curve = _curve(np.stack([whole.left_out(*words, k), markers.left_out], 1), toxic, weight)
    markers.left_out = None
    base = markers.prior if len(ids) else 0.0
    shared = spark.sparkContext.broadcast((terms, vocabulary, markers, whole))
    kept = docs.drop("text", *MADE)
    names = kept.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, known, markers, whole = shared.value
        marks, known = Lookup(marks), Lookup(known)
        at = TaskContext.get().partitionId() << 40
        for big in slices(batches, "text"):
            for lo in range(0, big.num_rows, ROWS):
                batch = big.slice(lo, ROWS)
                n = batch.num_rows
                mark, word, rest = read_terms(batch.column("text"), marks, known)
                row, slot, count = word
                weights = (1.0 + np.log(count)) * whole.idf[slot]
                square = np.bincount(row, weights=weights**2, minlength=n)
                who, product = whole.nearest(row, slot, weights, n, k)
                odds = np.full(n, markers.without_terms() if len(ids) else 0.0)
                row, slot, count = mark
                filled = np.unique(row)
                if len(filled):
                    near = markers.nearest(np.searchsorted(filled, row), slot, unit_weights(row, slot, count, markers.idf), k)
                    odds[filled] = markers.vote(*near)
                found = (product > 0).sum(1)
                place = np.repeat(np.arange(n), found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in names]
                    + [
                        pa.array(np.arange(at, at + n)),
                        _lists(place, who[product > 0], n, pa.int32()),
                        _lists(place, product[product > 0], n, pa.float64()),
                        pa.array(square, pa.float64()),
                        pa.array(odds, pa.float64()),
                        _lists(rest[0], signed(rest[1]), n, pa.int64()),
                        _lists(rest[0], rest[2], n, pa.int32()),
                    ],
                    names=[*names, *SEARCHED],
                )
                at += n

    schema = widened(
        kept.schema.fields,
        "row_at long, nearest array<int>, product array<double>, square double, odds double, rest array<long>, rest_counts array<int>",
    )
    rows = cut_lineage(docs.select(*names, "text").mapInArrow(search, schema))
    shared.destroy()
    rest = rest_squares(rows.select("row_at", "rest", "rest_counts"), n_docs)
    rows = rows.drop("rest", "rest_counts").join(rest, "row_at", "left").fillna(0.0, ["rest_square"])
    yes, every, keys, prior = whole.toxic, whole.total, whole.keys, whole.prior  # a few numbers for each example

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            place, near, product = _listed(batch, "nearest", "product")
            norm = np.sqrt(batch.column("square").to_numpy() + batch.column("rest_square").to_numpy())
            rank = np.arange(len(place)) - np.searchsorted(place, np.arange(n))[place]
            who, cosine = np.zeros((n, k), np.int64), np.full((n, k), -1.0)
            who[place, rank], cosine[place, rank] = near, np.minimum(product / np.where(norm > 0, norm, 1.0)[place], 1.0)
            score = np.full(n, base)
            if curve is not None:
                score = probability(curve, np.stack([vote(cosine, yes[who], every[who], prior), batch.column("odds").to_numpy()], 1))
            evidence = [
                [{"doc_id": int(keys[w]), "cosine": float(c)} for w, c in zip(who[i, :3], cosine[i, :3]) if c > 0] for i in range(n)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [
                    pa.array(np.clip(score, 0.0, 1.0)),
                    pa.array((score >= 0.5).astype(np.int32)),
                    pa.array(evidence, pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))),
                ],
                names=[*names, "score", "predicted", "evidence"],
            )

    schema = widened(kept.schema.fields, "score double, predicted int, evidence array<struct<doc_id:bigint,cosine:double>>")
    return rows.mapInArrow(scored, schema).withColumn("held_out", F.coalesce(fold() == 0, F.lit(False)))


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _listed(batch: pa.RecordBatch, first: str, second: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, second) of two list columns in row order."""
    spans = np.diff(np.asarray(batch.column(first).offsets))
    values = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (first, second)]
    return np.repeat(np.arange(batch.num_rows), spans), values[0].astype(np.int64), values[1]
