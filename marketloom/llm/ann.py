"""Nearest neighbours by low-dimensional stable projections, a kd-tree over them, and a chi-square stopping test.

Vectors are projected by ``DIMENSIONS`` Gaussian directions. If two vectors are r apart, the squared distance of their
projections, divided by r squared, follows a chi-square law. So once the next projected distance D of an incremental search satisfies
F(D^2 / d_k^2) >= ``CONFIDENCE``, where d_k is the k-th best exact distance so far, any nearer vector not yet verified would be
an event of less than 1 - ``CONFIDENCE``, and the search stops. What is verified is measured exactly, in double precision.

The kd-tree's splits are fitted on at most ``SAMPLE`` vectors; every vector is put into a cell, and cells are stored as blocks
of about ``BLOCK_ROWS`` rows, a crowded cell (many equal vectors) as many blocks. A query first searches its own
cell, which bounds d_k, and then every cell whose box is within the stopping radius; queries travel in batches, and each block
returns at most k rows per query.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows without id. Shorter
vectors count as padded with zeros. Rows of one vec_id are never each other's neighbours; a neighbour's id is listed once, at its
nearest. Queries that share an id are one, the first in the order of their bytes. With fewer candidates than k all are found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import cut_lineage

K = 10
DIMENSIONS = 8
CONFIDENCE = 0.98
SAMPLE = 16_384
LEAST_SAMPLED = 8
BLOCK_ROWS = 4096
QUERY_ROWS = 256
STEP = 256
SEED = 4711


def chi_square_quantile(share: float, freedom: int) -> float:
    """Quantile of the chi-square law for an even number of degrees of freedom."""

    def below(x: float) -> float:
        return 1.0 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))

    lo, hi = 0.0, 1.0
    while below(hi) < share:
        hi *= 2
    for _ in range(100):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if below(middle) < share else (lo, middle)
    return hi


@dataclass
class Tree:
    """Projection and splits: cell i of 2^depth is found by ``depth`` comparisons in heap order."""

    projection: np.ndarray
    axis: np.ndarray
    value: np.ndarray
    depth: int
    low: np.ndarray
    high: np.ndarray

    def cells(self, projected: np.ndarray) -> np.ndarray:
        node = np.zeros(len(projected), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (projected[np.arange(len(projected)), self.axis[node]] >= self.value[node])
        return node - (2**self.depth - 1)

    def distances(self, projected: np.ndarray) -> np.ndarray:
        """Projected distance from each query to each cell's box."""
        out = np.zeros((len(projected), len(self.low)))
        for j in range(projected.shape[1]):
            x = projected[:, j : j + 1]
            out += np.maximum(np.maximum(self.low[:, j] - x, x - self.high[:, j]), 0.0) ** 2
        return np.sqrt(out)


def grow(sample: np.ndarray, rows: int, dimension: int, seed: int = SEED) -> Tree:
    """A kd-tree of medians over the sample's projections, with about ``BLOCK_ROWS`` of ``rows`` rows to a cell."""
    projection = np.random.Generator(np.random.PCG64(seed)).normal(size=(dimension, DIMENSIONS))
    wanted = min(-(-rows // BLOCK_ROWS), max(len(sample) // LEAST_SAMPLED, 1))
    depth = max(0, math.ceil(math.log2(max(wanted, 1))))
    axis, value = np.zeros(2**depth, np.int64), np.zeros(2**depth)
    low, high = np.full((2**depth, DIMENSIONS), -np.inf), np.full((2**depth, DIMENSIONS), np.inf)

    def split(node: int, points: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: int) -> None:
        if not left:
            low[node - (2**depth - 1)], high[node - (2**depth - 1)] = lo, hi
            return
        j = int(points.var(0).argmax()) if len(points) else 0
        v = float(np.median(points[:, j])) if len(points) else 0.0
        axis[node], value[node] = j, v
        up = points[:, j] >= v
        middle_hi, middle_lo = hi.copy(), lo.copy()
        middle_hi[j], middle_lo[j] = v, v
        split(2 * node + 1, points[~up], lo, middle_hi, left - 1)
        split(2 * node + 2, points[up], middle_lo, hi, left - 1)

    split(0, sample @ projection, np.full(DIMENSIONS, -np.inf), np.full(DIMENSIONS, np.inf), depth)
    return Tree(projection, axis, value, depth, low, high)


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A list column as rows of ``dimension`` doubles, padded with zeros; a null component becomes not-a-number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    out = np.zeros((len(column), dimension))
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = values
    return out


def _usable(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return np.isfinite(vectors).all(1) & (vectors != 0).any(1)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _top(ids: np.ndarray, far: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest, ties to the smaller id, each id once."""
    order = np.lexsort((ids, far))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def search_block(
    ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray, query: np.ndarray, own: int, at: np.ndarray, bound: float, k: int, reach: float
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest of one block: projected neighbours in order, verified until the test holds.

    ``bound`` is the k-th distance known before; ``reach`` the ratio of projected to true distance at which to stop.
    """
    apart = np.sqrt(((projected - at) ** 2).sum(1))
    apart[ids == own] = np.inf
    inside = np.flatnonzero(apart <= (bound * reach if np.isfinite(bound) else np.finfo(float).max))
    order = inside[np.argsort(apart[inside], kind="stable")]
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    for lo in range(0, len(order), STEP):
        if apart[order[lo]] > bound * reach:
            break
        some = order[lo : lo + STEP]
        difference = vectors[some] - query
        far = np.sqrt(np.einsum("ij,ij->i", difference, difference))
        near = far <= bound
        all_ids, all_far = np.concatenate([best_ids, ids[some[near]]]), np.concatenate([best, far[near]])
        top = _top(all_ids, all_far, k)
        best_ids, best = all_ids[top], all_far[top]
        if len(best) == k:
            bound = min(bound, best[-1])
    return best_ids, best


FOUND = "query_id long, vec_id long, score double"


def _searched(pairs: DataFrame, tree: Tree, k: int, reach: float) -> DataFrame:
    """``pairs`` has a block (ids, vectors) and a batch of queries (list of id, vector, bound) in each row."""
    shared = pairs.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        dimension = tree.projection.shape[0]
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                vectors = np.frombuffer(batch.column("vectors")[i].as_py(), np.float64).reshape(-1, dimension)
                projected = vectors @ tree.projection
                asked, found, score = [], [], []
                for q in batch.column("queries")[i].as_py():
                    query = np.frombuffer(q["vector"], np.float64)
                    some, far = search_block(ids, vectors, projected, query, q["id"], query @ tree.projection, q["bound"], k, reach)
                    asked.append(np.full(len(some), q["id"]))
                    found.append(some)
                    score.append(far)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(asked).astype(np.int64)), pa.array(np.concatenate(found)), pa.array(np.concatenate(score))],
                    names=["query_id", "vec_id", "score"],
                )

    return pairs.select("ids", "vectors", "queries").mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(rows: DataFrame, is_query: Column, k: int = K, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of every row for which ``is_query`` holds.

    ``rows`` has vec_id and embedding; other columns are not read.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asked")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    )
    head = rows.agg(F.max(F.size("embedding")).alias("d"), F.count("*").alias("n")).head()
    dimension = head["d"] or 1
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
    sample = matrix(some.column("embedding"), dimension)
    tree = grow(sample[_usable(sample)], head["n"], dimension)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 4096):
                batch = big.slice(lo, 4096)
                vectors = matrix(batch.column("embedding"), dimension)
                use = _usable(vectors)
                cell = shared.value.cells(vectors[use] @ shared.value.projection)
                keep = pa.array(use)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").filter(keep), batch.column("asked").filter(keep), pa.array(cell, pa.int64()), _bytes(vectors[use])],
                    names=["vec_id", "asked", "cell", "vector"],
                )

    placed = cut_lineage(rows.mapInArrow(place, "vec_id long, asked boolean, cell long, vector binary"))
    # one row per cell, of which there are at most SAMPLE
    parts = cut_lineage(placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts")))

    def block(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("vec_id").to_numpy(), kind="stable")
        ids = rows.column("vec_id").to_numpy()[order]
        vectors = [rows.column("vector")[int(i)].as_py() for i in order]
        return pa.table(
            {
                "cell": rows.column("cell").slice(0, 1),
                "part": rows.column("part").slice(0, 1),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "vectors": pa.array([b"".join(vectors)], pa.binary()),
            }
        )

    index = cut_lineage(
        placed.join(parts, "cell")
        .withColumn("part", F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts")).cast("int"))
        .groupBy("cell", "part")
        .applyInArrow(block, "cell long, part int, ids binary, vectors binary")
    )
    queries = cut_lineage(
        placed.where("asked")
        .groupBy(F.col("vec_id").alias("id"))
        .agg(F.min(F.struct("vector", "cell")).alias("q"))
        .select("id", F.col("q.vector").alias("vector"), F.col("q.cell").alias("cell"))
    )
    reach = math.sqrt(chi_square_quantile(confidence, DIMENSIONS))

    def paired(asked: DataFrame) -> DataFrame:
        """Batches of queries next to each block of the cells they visit."""
        crowd = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("batches"))
        batched = (
            asked.join(crowd, "cell")
            .groupBy("cell", F.pmod(F.xxhash64("id"), F.col("batches")).alias("batch"))
            .agg(F.collect_list(F.struct("id", "vector", "bound")).alias("queries"))
            .join(parts, "cell")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        )
        return index.join(batched, ["cell", "part"])

    own = queries.withColumn("bound", F.lit(math.inf))
    first = cut_lineage(_searched(paired(own), tree, k, reach))
    bounds = _ranked(first, k).groupBy(F.col("query_id").alias("id")).agg(F.max("score").alias("far"), F.count("*").alias("n"))
    bounded = queries.join(bounds, "id", "left").withColumn("bound", F.when(F.col("n") == k, F.col("far")).otherwise(F.lit(math.inf)))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(batch.num_rows, -1)
            bound = batch.column("bound").to_numpy()
            apart = shared.value.distances(vectors @ shared.value.projection)
            go = apart <= np.where(np.isfinite(bound), bound * reach, np.inf)[:, None]
            go[np.arange(batch.num_rows), batch.column("cell").to_numpy()] = False
            row, cell = np.nonzero(go)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("vector").take(take), pa.array(cell, pa.int64()), batch.column("bound").take(take)],
                names=["id", "vector", "cell", "bound"],
            )

    visits = bounded.select("id", "vector", "cell", "bound").mapInArrow(visit, "id long, vector binary, cell long, bound double")
    second = _searched(paired(cut_lineage(visits)), tree, k, reach)
    return _ranked(first.unionByName(second), k).select("query_id", "rank", "vec_id", "score")
