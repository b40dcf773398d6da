"""Product codes of vectors: every vector is cut into equal parts, and each part is named by the nearest entry of its codebook.

Components become integers, floor(``SCALE`` * x), so sums, means (rounded down) and squared distances are exact and do not depend on the
order of rows or the number of partitions. Codebooks start with the parts of the first vectors by id; each round assigns all vectors and moves
every used entry to the mean of its parts.

The nearest entry is found by Orchard's search: every entry keeps the other entries of its codebook in the order of their distance to it.
A search starts at some entry, walks along that entry's list, jumps to the list of an entry as soon as it is nearer, skips
entries it has visited, and stops at an entry farther from the list's owner than twice the current distance: by the triangle inequality nothing
behind it can be nearer, or as near. All searches of a batch walk together, one step each, as arrays. The neighbour
lists are of codebook size squared (256 * 256 per part), made on the driver and sent with the task, as are the codebooks.

Per round the rows give one partial sum per task, part and entry; sums are added by Spark and only the entries reach the driver.

Vectors that are null or hold null or non-finite components take no part and give no row. Vectors of another length than that of the
first kept vector (by id) take no part either. A dimension that the parts do not divide is filled up with zeros. Integers are held
within +-2^27, so that no sum overflows. With fewer kept vectors than entries the codebooks have as many entries as
vectors. Rows that share an id are rows of their own, taken in the order of their components; null ids come last. Equal
distances go to the lower entry. Other columns are carried along; those named like a made one are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import widened
from marketloom.session import cut_lineage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BOUND = 1 << 27
BATCH = 4096
MADE = ("whole", "code", "error")


@dataclass
class Codebook:
    """The entries of one part with, for every entry, the others in the order of distance."""

    entries: np.ndarray  # entry x component
    apart: np.ndarray  # squared distances between entries
    lists: np.ndarray  # entry x rank
    line: np.ndarray  # sums of the entries' components in order, and whose they are, to start a search
    line_entry: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        lists = np.argsort(apart, axis=1, kind="stable")
        sums = entries.sum(1)
        order = np.argsort(sums, kind="stable")
        return cls(entries, apart, lists, sums[order], order)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of each point's nearest entry, and the number of distances that were computed."""
        n, size = len(points), len(self.entries)
        start = np.minimum(np.searchsorted(self.line, points.sum(1)), size - 1)
        at = self.line_entry[start].copy() if n else start
        best = ((points - self.entries[at]) ** 2).sum(1)
        visited = np.zeros((n, size), bool)
        visited[np.arange(n), at] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        measured = n
        while len(walking):
            owner = at[walking]
            entry = self.lists[owner, place[walking]]
            within = self.apart[owner, entry] <= 4 * best[walking]
            walking, entry = walking[within], entry[within]
            place[walking] += 1
            new = ~visited[walking, entry]
            asked, entry = walking[new], entry[new]
            visited[asked, entry] = True
            gap = ((points[asked] - self.entries[entry]) ** 2).sum(1)
            measured += len(asked)
            nearer = (gap < best[asked]) | ((gap == best[asked]) & (entry < at[asked]))
            asked, entry = asked[nearer], entry[nearer]
            at[asked], best[asked], place[asked] = entry, gap[nearer], 0
            walking = walking[place[walking] < size]
        return at, best, measured


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS, key: str = "vec_id") -> DataFrame:
    """``rows`` without the vector, with its integer components in ``whole``; rows without a usable vector are gone."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    held = F.transform(x, lambda v: F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), v * float(scale))))
    whole = F.transform(held, lambda v: F.floor(v).cast("long"))
    kept = [F.col(c) for c in rows.columns if c not in (vector, *MADE)]
    found = rows.where(F.coalesce(usable, F.lit(False))).select(*kept, whole.alias("whole"))
    first = found.orderBy(F.col(key).asc_nulls_last(), "whole").select(F.size("whole").alias("n")).first()
    if first is None:
        return found
    fill = F.array_repeat(F.lit(0).cast("long"), -first["n"] % parts)
    return found.where(F.size("whole") == first["n"]).withColumn("whole", F.concat("whole", fill))


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """row x part x component."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), parts, -1) if len(column) else np.zeros((0, parts, 1), np.int64)


def _assigned(batches: Iterator[pa.RecordBatch], books: list[Codebook]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for big in batches:
        for lo in range(0, big.num_rows, BATCH):
            batch = big.slice(lo, BATCH)
            points = _matrix(batch.column("whole"), len(books))
            found = [book.nearest(points[:, p]) for p, book in enumerate(books)]
            yield batch, points, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part x entry x component) after one round over all ``vectors``."""
    parts, size, width = books.shape
    sums = [f"s{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, size, width + 1), np.int64)
        for _, points, entry, _ in _assigned(batches, [Codebook.of(b) for b in books]):
            for p in range(parts):
                np.add.at(total[p, :, 1:], entry[:, p], points[:, p])
                total[p, :, 0] += np.bincount(entry[:, p], minlength=size)
        used = np.argwhere(total[:, :, 0] > 0)
        values = total[used[:, 0], used[:, 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0]), pa.array(used[:, 1]), *[pa.array(values[:, j]) for j in range(width + 1)]],
            names=["part", "entry", "n", *sums],
        )

    kinds = "part long, entry long, n long, " + ", ".join(f"{s} long" for s in sums)
    totals = vectors.select("whole").mapInArrow(run, kinds).groupBy("part", "entry")
    out = books.copy()
    for r in totals.agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect():  # parts * entries rows
        out[r["part"], r["entry"]] = [r[s] // r["n"] for s in sums]
    return out


def start_books(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, key: str = "vec_id") -> np.ndarray:
    """The parts of the first vectors by id."""
    first = vectors.orderBy(F.col(key).asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    points = np.array([r["whole"] for r in first], np.int64)
    return points.reshape(len(points), parts, -1).transpose(1, 0, 2).copy()


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(
    rows: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    entries: int = ENTRIES,
    parts: int = PARTS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(``rows`` without the vector, with ``code`` (the entries' numbers, two hex digits a part) and ``error`` (the squared distances
    summed over the parts); the codebooks)."""
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    vectors = cut_lineage(whole_vectors(rows, vector, scale, parts, key))
    kept = vectors.drop("whole")
    names = kept.columns
    schema = widened(kept.schema.fields, "code string, error long")
    if vectors.limit(1).count() == 0:
        return rows.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    books = start_books(vectors, entries, parts, key)
    for _ in range(rounds):
        books = moved(vectors, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, entry, gap in _assigned(batches, [Codebook.of(b) for b in books]):
            digits = entry.astype(np.uint8)
            code = pa.array([d.tobytes().hex() for d in digits], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [code, pa.array(gap.sum(1), pa.int64())], names=[*names, "code", "error"]
            )

    return vectors.select(*names, "whole").mapInArrow(run, schema), books
