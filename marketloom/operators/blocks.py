"""Rows of a numeric matrix packed into blocks of doubles, and passes over all blocks.

A table is packed once; from then on every pass of an iterative fit works on whole arrays and returns one state per task. States merge in
two levels when there are many tasks, so the driver holds about the square root of their number. Equal rows of a block are one row with a
count. Rows with a missing or non-finite component are left out.

Where a pass of all starts over all rows would be too much work, starts converge on the sums of all rows by cell (the rows nearest to a
point of the weighted draw), and the best of each k converge over all rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.lookup import spread
from marketloom.session import cut_lineage

BLOCK_ROWS = 8192
PART_ROWS = 2048  # rows a kernel looks at together
FAN_IN = 64
DRAWS = 256
PASSES = 4
FINAL_ROWS = 8_000_000  # rows times starts of one k that a pass over all rows may take


def pack(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` distinct rows of ``columns`` (``x``) with their counts (``w``), stored."""
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            x, w = distinct(np.concatenate(held), None)
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], names=["x", "w"])

        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], 1)
            x = x[np.isfinite(x).all(1)]
            for at in range(0, len(x), BLOCK_ROWS):
                part = x[at : at + BLOCK_ROWS]
                if size + len(part) > BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
                held.append(part)
                size += len(part)
        if size:
            yield block()

    wide = spread(matrix.select(*[F.col(c).cast("double").alias(c) for c in names]))
    return cut_lineage(wide.mapInArrow(run, "x binary, w binary"))


def distinct(x: np.ndarray, w: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of ``x`` in order, with their summed counts."""
    x = np.ascontiguousarray(x) + 0.0
    order = np.lexsort(x.T[::-1])
    x = x[order]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(1))) if len(x) else np.zeros(0, int)
    counts = np.ones(len(x)) if w is None else w[order]
    return x[first], np.add.reduceat(counts, first) if len(x) else counts


def gather(
    blocks: DataFrame,
    width: int,
    step: Callable[[np.ndarray | None, np.ndarray, np.ndarray, np.random.Generator], np.ndarray],
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray],
    finish: Callable[[np.ndarray], np.ndarray] = lambda state: state,
    seed: int = 0,
    fan_in: int | None = None,
) -> np.ndarray | None:
    """One state over all blocks: ``step`` takes a task's state (None at first), rows and counts; states are merged. A generator
    depends on ``seed`` and the block's content only. States are two-dimensional arrays of doubles; None without rows.

    Where a merge is much work, ``fan_in`` is the number of states that any task, and the driver, merges in a row."""

    def packed(state: np.ndarray, part: int) -> pa.RecordBatch:
        shape = pa.array([state.shape[1]], pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), shape, pa.array([np.ascontiguousarray(state).tobytes()], pa.binary())], names=["part", "width", "state"])

    def unpacked(width: int, state: bytes) -> np.ndarray:
        return np.frombuffer(state, np.float64).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for x, w in zip(batch.column("x"), batch.column("w")):
                raw = x.as_py()
                rng = np.random.default_rng([seed, zlib.crc32(raw)])
                state = step(state, np.frombuffer(raw, np.float64).reshape(-1, width), np.frombuffer(w.as_py(), np.float64), rng)
        if state is not None:
            yield packed(finish(state), TaskContext.get().partitionId())

    def merged(rows: pa.Table) -> pa.Table:
        state = None
        for w, s in zip(rows.column("width").to_pylist(), rows.column("state").to_pylist()):
            state = unpacked(w, s) if state is None else merge(state, unpacked(w, s))
        return pa.Table.from_batches([packed(state, rows.column("part")[0].as_py())])

    def united(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [row for batch in batches for row in batch.select(["part", "width", "state"]).to_pylist()]
            state = None
            for row in sorted(held, key=lambda row: row["part"]):
                one = unpacked(row["width"], row["state"])
                state = one if state is None else merge(state, one)
            if state is not None:
                yield packed(state, held[0]["part"] % groups)

        return run

    kinds = "part int, width int, state binary"
    found = blocks.mapInArrow(run, kinds)
    tasks = blocks.rdd.getNumPartitions()
    if fan_in is not None:
        while tasks > fan_in:
            tasks = -(-tasks // fan_in)
            found = found.withColumn("at", F.col("part") % tasks).repartitionById(tasks, "at").mapInArrow(united(tasks), kinds)
    elif tasks > FAN_IN:
        found = found.groupBy(F.col("part") % math.isqrt(tasks)).applyInArrow(merged, kinds)
    state = None
    for r in sorted(found.collect(), key=lambda r: r["part"]):
        one = unpacked(r["width"], bytes(r["state"]))
        state = one if state is None else merge(state, one)
    return state


def total(blocks: DataFrame, width: int, kernel: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of the kernel's arrays over all rows, given in parts that fit a cache."""

    def step(state, x, w, _):
        for at in range(0, len(x), PART_ROWS):
            part = kernel(x[at : at + PART_ROWS], w[at : at + PART_ROWS])
            state = part if state is None else state + part
        return state

    return gather(blocks, width, step, np.add)


def square_gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, less the rows' squared norms."""
    return (centres**2).sum(1)[None, :] - 2 * x @ centres.T


def monomials(x: np.ndarray) -> np.ndarray:
    """1, x and the products of the elements of x, by row."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([np.ones((len(x), 1)), x, x[:, i] * x[:, j]], 1)


def weighted_draws(blocks: DataFrame, width: int, seed: int, draws: int = DRAWS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(points, weights): points drawn over all rows, first one in proportion to counts, then ``passes`` times ``draws`` in proportion to
    count times squared distance from those drawn before; the weight is the number of rows nearest to a point.

    Drawn without replacement by exponential keys, so a pass keeps ``draws`` rows per task. A point of many equal rows has no
    distance left once it is drawn, so it cannot take the draws of the others.
    """

    def lowest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        both = np.concatenate([a, b])
        return both[np.argsort(both[:, 0], kind="stable")[:n]]

    def draw(n: int, known: np.ndarray | None, turn: int) -> np.ndarray:
        def step(state, x, w, rng):
            weight = w
            if known is not None:
                gap = np.concatenate([square_gaps(x[at : at + PART_ROWS], known).min(1) for at in range(0, len(x), PART_ROWS)])
                norm = (x**2).sum(1)
                weight = w * np.where(gap + norm > 1e-12 * norm, gap + norm, 0.0)
            key = rng.exponential(size=len(x))
            some = np.flatnonzero(weight > 0)
            rows = np.concatenate([(key[some] / weight[some])[:, None], x[some]], 1)
            return lowest(np.zeros((0, 1 + width)) if state is None else state, rows, n)

        found = gather(blocks, width, step, lambda a, b: lowest(a, b, n), seed=seed * 1000 + turn)
        return np.zeros((0, width)) if found is None else found[:, 1:]

    points = draw(1, None, 0)
    for turn in range(passes if len(points) else 0):
        new = draw(draws, points, turn + 1)
        if not len(new):
            break
        points = distinct(np.concatenate([points, new]), None)[0]
    if not len(points):
        return points, np.zeros(0)

    def count(x, w):
        return np.bincount(square_gaps(x, points).argmin(1), weights=w, minlength=len(points))[None, :]

    return points, total(blocks, width, count)[0]


def plus_plus(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k starting centres among weighted points, each drawn in proportion to weight and squared distance to those before."""
    pick = lambda p: int(rng.choice(len(points), p=p / p.sum())) if p.sum() > 0 else int(rng.integers(len(points)))
    chosen = [pick(weights)]
    nearest = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        chosen.append(pick(weights * nearest))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen].copy()


def refined(points: np.ndarray, weights: np.ndarray, centres: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Centres after rounds of k-means on weighted points, until nothing changes."""
    last = None
    for _ in range(rounds):
        at = square_gaps(points, centres).argmin(1)
        if last is not None and (at == last).all():
            break
        n = np.bincount(at, weights=weights, minlength=len(centres))
        sums = np.stack([np.bincount(at, weights=weights * c, minlength=len(centres)) for c in points.T], 1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centres)
        last = at
    return centres


def cell_sums(blocks: DataFrame, width: int, points: np.ndarray, terms: Callable[[np.ndarray], np.ndarray] = monomials) -> np.ndarray:
    """The summed ``terms`` of all rows by the point they are nearest to, points without rows left out."""

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        at = square_gaps(x, points).argmin(1)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        rows = terms(x) * w[:, None]
        out = np.zeros((len(points), rows.shape[1]))
        out[at[order[first]]] = np.add.reduceat(rows[order], first)
        return out

    found = total(blocks, width, kernel)
    return found[found[:, 0] > 0]


def finalists(plans: Sequence[tuple[int, int]], cost: Sequence[float], n: float) -> list[int]:
    """The starts of each k that go on over all rows: those of lowest cost, as many as ``FINAL_ROWS`` allows, one at least."""
    most = max(1, int(FINAL_ROWS // max(n, 1)))
    out = []
    for k in dict(plans):
        own = [i for i, p in enumerate(plans) if p[0] == k]
        out += sorted(own, key=lambda i: (cost[i], i))[:most]
    return sorted(out)


def all_final(plans: Sequence[tuple[int, int]], n: float) -> bool:
    """Whether no start would be left out by ``finalists``."""
    return len(finalists(plans, [0.0] * len(plans), n)) == len(plans)


def starts(blocks: DataFrame, width: int, plans: Sequence[tuple[int, int]], seed: int, drawn: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """Starting centres for each (k, start): seeded and refined on one shared weighted draw over all rows."""
    points, weights = weighted_draws(blocks, width, seed) if drawn is None else drawn
    if not len(points):
        return [np.zeros((k, width)) for k, _ in plans]
    return [refined(points, weights, plus_plus(points, weights, k, np.random.default_rng([seed, k, start]))) for k, start in plans]


def hopeless(plans: Sequence[tuple[int, int]], cost: dict[int, float], gain: dict[int, float], active: set[int], horizon: int = 20) -> set[int]:
    """The starts that another start of the same k beats even if they gained for ``horizon`` more rounds what they gained in the last."""
    out = set()
    for i in active:
        best = min(cost[j] for j in cost if plans[j][0] == plans[i][0])
        if cost[i] - horizon * max(gain[i], 0.0) > best:
            out.add(i)
    return out
