"""Distance of every row to its k-th nearest row, exactly, over blocks of a kd-tree.

The tree has a cell for each ``BLOCK_ROWS`` rows, ``MOST_CELLS`` at most, with splits fitted on ``LEAST_SAMPLED`` rows a cell; every row
goes into a cell, and a cell is one block unless it is crowded. A block is halved into leaves of ``LEAF_ROWS`` rows; a leaf is compared with
itself and then with the leaves whose boxes are nearer than its rows' bounds, nearest first. Only rows whose bound reaches beyond their block
ask again: they visit the pages (consecutive leaves) of other blocks whose boxes are within the bound, in batches, and bring back at most k
distances from each. All other rows are settled where they are and are not shuffled again.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.groups import sample_rows
from marketloom.operators.ranks import range_bounds, with_bucket
from marketloom.session import cut_lineage

SAMPLE = 16_384
LEAST_SAMPLED = 8
MOST_CELLS = 1 << 16
BLOCK_ROWS = 1 << 15
WHOLE_BLOCKS = 4  # a cell of up to so many blocks' rows is not cut
LEAF_ROWS = 24
BRANCH_LEAVES = 32
BOX_ROWS = 1024
MOST_BOXES = 1 << 18
PAGE_BOXES = 8
PAGE_BITS = 24
TASK_ROWS = 250_000
QUERY_ROWS = 512
GAPS = 1 << 16  # gaps held at once
FIRST_LEAVES, MOST_LEAVES = 4, 64  # leaves that a leaf is compared with in one round
FAR = 1e200  # its square is infinite
KNEE_BUCKETS = 1 << 16


def _splits(points: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Axis and value of each split in heap order, by medians along the widest axis, and the depth."""
    depth = max(0, math.ceil(math.log2(max(min(cells, len(points) // LEAST_SAMPLED), 1))))
    axis, value = np.zeros(2**depth, np.int64), np.zeros(2**depth)
    parts = {0: points}
    for node in range(2**depth - 1):
        own = parts.pop(node)
        if len(own):
            axis[node] = int(own.var(0).argmax())
            value[node] = float(np.median(own[:, axis[node]]))
        up = own[:, axis[node]] >= value[node]
        parts[2 * node + 1], parts[2 * node + 2] = own[~up], own[up]
    return axis, value, depth


def _fitting_rows(wide: DataFrame, total: int) -> DataFrame:
    """The rows the splits are fitted on: ``SAMPLE`` of them, more only if the cells ask for it. The distances don't depend on them."""
    wanted = LEAST_SAMPLED * min(-(-total // BLOCK_ROWS), MOST_CELLS)
    if wanted <= SAMPLE:
        return sample_rows(wide, SAMPLE, "key")
    return wide.where(F.pmod(F.xxhash64("key"), F.lit(total)) < wanted).limit(2 * wanted)


def _rows(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The rows of doubles in a binary column."""
    if isinstance(column, pa.ChunkedArray):
        return np.concatenate([_rows(c, width) for c in column.chunks] or [np.zeros((0, width))])
    if not len(column):
        return np.zeros((0, width))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.float64, (ends[-1] - ends[0]) // 8, ends[0]).reshape(-1, width)


def _binaries(x: np.ndarray) -> pa.Array:
    """Each row of doubles as one binary."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (8 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x, float))])


def _least(gap: np.ndarray, k: int) -> np.ndarray:
    """The k smallest along the last axis, unordered; infinite where there are fewer."""
    if gap.shape[-1] > k:
        return np.partition(gap, k - 1, axis=-1)[..., :k]
    return np.concatenate([gap, np.full((*gap.shape[:-1], k - gap.shape[-1]), np.inf)], -1)


def _leaves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, ends): rows in an order in which leaves, and whole branches of them, are consecutive; ends of the leaves from 0 on."""
    order, ends = np.arange(len(x)), np.array([0, len(x)])
    while np.diff(ends).max() > LEAF_ROWS:
        at, size = ends[:-1], np.diff(ends)
        branch, y = np.repeat(np.arange(len(size)), size), x[order]
        axis = (np.maximum.reduceat(y, at) - np.minimum.reduceat(y, at)).argmax(1)
        order = order[np.lexsort((y[np.arange(len(x)), axis[branch]], branch))]
        ends = np.sort(np.concatenate([ends, at + (size + 1) // 2]))
    return order, ends


def _box_gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances between each box of the first and each of the second; a point is a box."""
    gap = np.zeros((len(low), len(lows)))
    for j in range(low.shape[1]):
        step = np.maximum(lows[None, :, j] - high[:, j, None], low[:, j, None] - highs[None, :, j])
        np.maximum(step, 0.0, out=step)
        gap += step * step
    return gap


def _close_leaves(low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, other, gap) of the other leaves nearer to a leaf than its bound, by leaf and gap. Branches of leaves are ruled out together."""
    start = np.arange(0, len(low), BRANCH_LEAVES)
    end = np.append(start[1:], len(low))
    branch_low, branch_high = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
    apart = _box_gaps(branch_low, branch_high, branch_low, branch_high)
    close, found = apart < np.maximum.reduceat(bound, start)[:, None], []
    for i, (a, b) in enumerate(zip(start, end)):
        others = np.concatenate([np.arange(start[j], end[j]) for j in np.flatnonzero(close[i])] or [np.zeros(0, int)])
        gap = _box_gaps(low[a:b], high[a:b], low[others], high[others])
        leaf, other = np.nonzero((gap < bound[a:b, None]) & (others != np.arange(a, b)[:, None]))
        found.append((leaf + a, others[other], gap[leaf, other]))
    leaf, other, gap = (np.concatenate(parts) for parts in zip(*found))
    order = np.lexsort((gap, leaf))
    return leaf[order], other[order], gap[order]


def reaching(x: np.ndarray, bound: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place), once each, of the boxes that are nearer to a row of ``x`` than its bound; rows close to each other are looked at together first."""
    start, most = np.arange(0, len(x), LEAF_ROWS), int(place.max(initial=0)) + 1
    leaf_low, leaf_high, leaf_bound = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start), np.maximum.reduceat(bound, start)
    found, many, pairs = [np.zeros(0, np.int64)], max(1, GAPS // max(len(low), 1)), GAPS // LEAF_ROWS
    for at in range(0, len(start) if len(low) else 0, many):
        leaf, box = np.nonzero(_box_gaps(leaf_low[at : at + many], leaf_high[at : at + many], low, high) < leaf_bound[at : at + many, None])
        for i in range(0, len(leaf), pairs):
            some, slot = box[i : i + pairs], start[leaf[i : i + pairs] + at, None] + np.arange(LEAF_ROWS)
            gap, last = np.zeros(slot.shape), np.minimum(slot, len(x) - 1)
            for j in range(x.shape[1]):
                step = np.maximum(low[some, j][:, None] - x[last, j], x[last, j] - high[some, j][:, None])
                np.maximum(step, 0.0, out=step)
                gap += step * step
            pair, row = np.nonzero((gap < bound[last]) & (slot < len(x)))
            found.append(slot[pair, row] * most + place[some[pair]])
    return np.divmod(np.unique(np.concatenate(found)), most)


def nearer(queries: np.ndarray, bound: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, square) of the k smallest squared distances to the rows of ``x``, consecutive ones being near each other, below a query's bound."""
    start = np.arange(0, len(x), LEAF_ROWS)
    low, high, found = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start), []
    many, pairs = max(1, GAPS // len(start)), GAPS // LEAF_ROWS
    for at in range(0, len(queries), many):
        query, leaf = np.nonzero(_box_gaps(queries[at : at + many], queries[at : at + many], low, high) < bound[at : at + many, None])
        query += at
        for i in range(0, len(query), pairs):
            some, slot = query[i : i + pairs], start[leaf[i : i + pairs], None] + np.arange(LEAF_ROWS)
            gap, last = np.zeros(slot.shape), np.minimum(slot, len(x) - 1)
            for j in range(x.shape[1]):
                step = queries[some, j][:, None] - x[last, j]
                gap += step * step
            pair, row = np.nonzero((gap < bound[some, None]) & (slot < len(x)))
            found.append((some[pair], gap[pair, row]))
    query, square = (np.concatenate(p) for p in zip(*found)) if found else (np.zeros(0, int), np.zeros(0))
    order = np.lexsort((square, query))
    query, square = query[order], square[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[kept], square[kept]


def block_squares(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, ends, squares): the leaves of ``x`` and, in their order, the k smallest squared distances of each row to rows of ``x``, unordered."""
    order, ends = _leaves(x)
    y, size = x[order], np.diff(ends)
    slot = ends[:-1, None] + np.arange(size.max())
    real = slot < ends[1:, None]
    apart = y[:, (y != y[0]).any(0)] if (y != y[0]).any() else y[:, :1]  # features without spread add nothing
    leaves = np.full((apart.shape[1], len(size) + 1, real.shape[1]), FAR)  # feature, leaf, row; the last leaf is empty
    leaves[:, :-1] = np.where(real[:, :, None], apart[np.minimum(slot, len(x) - 1)], FAR).transpose(2, 0, 1)
    best, bound = np.empty((*real.shape, k)), np.full(real.shape, -np.inf)

    def compare(mine: np.ndarray, rows: np.ndarray, others: np.ndarray, more: bool) -> None:
        """Compare ``rows`` (one or all) of each leaf in ``mine`` with the rows of the leaves ``others``, and what is kept of it, if ``more``."""
        gap = np.zeros((*rows.shape, others.shape[1] * real.shape[1]))
        for values in leaves:
            step = values[mine[:, None], rows][:, :, None] - values[others].reshape(len(mine), 1, -1)
            step *= step
            gap += step
        at = (mine[:, None], rows)
        best[at] = _least(np.concatenate([best[at], gap], -1) if more else gap, k)
        bound[at] = np.where(real[at], best[at].max(-1), -np.inf)

    with np.errstate(over="ignore"):
        every = np.arange(real.shape[1])[None]
        step = max(1, GAPS // real.shape[1] ** 2)
        for start in range(0, len(size), step):
            some = np.arange(start, min(start + step, len(size)))
            compare(some, np.repeat(every, len(some), 0), some[:, None], False)
        at = ends[:-1]
        leaf, other, gap = _close_leaves(np.minimum.reduceat(y, at), np.maximum.reduceat(y, at), bound.max(1))
        place, last = np.searchsorted(leaf, np.arange(len(size))), np.searchsorted(leaf, np.arange(len(size)), "right")
        taken, alone = FIRST_LEAVES, False
        while len(leaf):
            live = np.flatnonzero(place < last)
            reached = bound[live] > gap[place[live], None]
            if not reached.any():
                break
            # all rows of a leaf together at first, later only those that the next leaves are in reach of
            mine, rows = (live[reached.any(1)], None) if not alone else (live[np.nonzero(reached)[0]], np.nonzero(reached)[1][:, None])
            step = max(1, GAPS // (real.shape[1] * taken * (1 if alone else real.shape[1])))
            for start in range(0, len(mine), step):
                some = mine[start : start + step]
                asked = place[some, None] + np.arange(taken)
                others = np.where(asked < last[some, None], other[np.minimum(asked, len(other) - 1)], len(size))
                compare(some, rows[start : start + step] if alone else np.repeat(every, len(some), 0), others, True)
            place[live] += taken
            taken, alone = min(2 * taken, MOST_LEAVES) if alone else taken, True
    return order, ends, best[real]


def k_distances(matrix: DataFrame, columns: Sequence[str], k: int = 5, key: str = "id") -> DataFrame:
    """(key, distance): Euclidean distance to the k-th nearest row, the row itself being the first.

    Rows of a table of fewer than k rows have no such distance and are left out. ``key`` is unique; rows that share one are told by the
    k-th smallest of all their distances.
    """
    spark, names, width = matrix.sparkSession, list(columns), len(columns)
    wide = matrix.select(F.col(key).alias("key"), *[F.col(c).cast("double").alias(c) for c in names])
    wide = wide.where(reduce(Column.__and__, [F.col(c).isNotNull() & ~F.isnan(c) for c in names]))  # others have no distance
    counts = wide.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("key").alias("keys")).first()
    total, key_type = counts["rows"], wide.schema["key"].dataType.simpleString()
    if total < k:
        return spark.createDataFrame([], f"{key} {key_type}, distance double")
    points = _fitting_rows(wide, total).toPandas()[names].to_numpy(dtype=float)  # at most LEAST_SAMPLED * MOST_CELLS, twice that for repeated keys
    axis, value, depth = _splits(points, min(-(-total // BLOCK_ROWS), MOST_CELLS))
    shared = F.lit(False)
    if counts["keys"] < total:
        again = wide.groupBy(F.col("key").alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        wide = wide.join(again, F.col("key").eqNullSafe(F.col("again")), "left")
        shared = F.col("n").isNotNull()
    wide = wide.select("key", shared.alias("shared"), *names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], 1)
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), axis[node]] >= value[node])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("shared"), pa.array(node - (2**depth - 1)), _binaries(x)],
                names=["key", "shared", "cell", "x"],
            )

    placed = cut_lineage(wide.mapInArrow(place, f"key {key_type}, shared boolean, cell long, x binary"))
    # at most 2 * MOST_CELLS cells
    crowded = F.ceil(F.count("*") / BLOCK_ROWS)
    parts = cut_lineage(
        placed.groupBy("cell").agg(F.when(crowded <= WHOLE_BLOCKS, 1).otherwise(crowded).cast("int").alias("parts"))
        .withColumn("first", F.sum("parts").over(Window.orderBy("cell")) - F.col("parts"))
    )
    box_rows = max(BOX_ROWS, -(-total // MOST_BOXES))

    def block(rows: pa.Table) -> pa.Table:
        x, found = _rows(rows.column("x"), width), []
        order, ends, best = block_squares(x, k)
        rows, x = rows.take(pa.array(order)), x[order]
        leaves = 1 << max(0, int(box_rows // np.diff(ends).max()).bit_length() - 1)
        at = ends[:-1][::leaves]
        low, high = np.minimum.reduceat(x, at), np.maximum.reduceat(x, at)
        keys, shared = rows.column("key").to_pylist(), rows.column("shared").to_numpy()
        for i in range(0, len(at), PAGE_BOXES):
            boxes, own = slice(i, i + PAGE_BOXES), slice(at[i], at[i + PAGE_BOXES] if i + PAGE_BOXES < len(at) else len(x))
            found.append((x[own].tobytes(), low[boxes].tobytes(), high[boxes].tobytes(), keys[own], shared[own].tobytes(), best[own].tobytes()))
        kinds = [pa.binary(), pa.binary(), pa.binary(), pa.list_(rows.schema.field("key").type), pa.binary(), pa.binary()]
        first = rows.column("block")[0].as_py() << PAGE_BITS
        return pa.table(
            [pa.array(np.arange(len(found)) + first), *[pa.array(list(b), t) for b, t in zip(zip(*found), kinds)]],
            names=["page", "rows", "low", "high", "keys", "shared", "best"],
        )

    pages = cut_lineage(
        placed.join(F.broadcast(parts), "cell")
        .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts"))).cast("long"))
        .select("block", "key", "shared", "x")
        .repartition(max(-(-total // TASK_ROWS), spark.sparkContext.defaultParallelism), "block")
        .groupBy("block")
        .applyInArrow(
            block, f"page long, rows binary, low binary, high binary, keys array<{key_type}>, shared binary, best binary"
        )
    )
    corners = pages.select("page", "low", "high").toPandas().sort_values("page")  # about MOST_BOXES boxes at most
    low, high = (np.frombuffer(b"".join(corners[c].tolist())).reshape(-1, width) for c in ("low", "high"))
    page = np.repeat(corners["page"].to_numpy(), [len(b) // (8 * width) for b in corners["low"]])
    places, number = np.unique(page, return_inverse=True)
    whose = page >> PAGE_BITS
    at = np.unique(whose, return_index=True)[1]
    block_low, block_high, block_end = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.append(at[1:], len(page))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every settled row with its square; any other row with the k of its block (page -1), and once for each page it has to visit."""
        for batch in batches:
            for i in range(batch.num_rows):
                x, keys = _rows(batch.column("rows").slice(i, 1), width), batch.column("keys")[i].values
                best = _rows(batch.column("best").slice(i, 1), k)
                away = np.frombuffer(batch.column("shared")[i].as_py(), bool).copy()
                square, own = best.max(1), batch.column("page")[i].as_py() >> PAGE_BITS
                blocks = np.flatnonzero(_box_gaps(x.min(0)[None], x.max(0)[None], block_low, block_high)[0] < square.max())
                near = np.concatenate([np.arange(at[b], block_end[b]) for b in blocks] or [np.zeros(0, int)])
                near = near[whose[near] != own]
                near = near[_box_gaps(x.min(0)[None], x.max(0)[None], low[near], high[near])[0] < square.max()]
                row, place = reaching(x, square, low[near], high[near], number[near])
                away[row] = True
                yield _answers(keys, row, square[row], x[row], places[place])
                row = np.flatnonzero(~away)
                yield _answers(keys, row, square[row])
                row = np.repeat(np.flatnonzero(away), k)
                yield _answers(keys, row, best[away].ravel(), place=np.full(len(row), -1))

    asked = f"key {key_type}, square double, x binary, page long"
    first = cut_lineage(pages.select("page", "rows", "keys", "shared", "best").mapInArrow(visit, asked))
    settled, mine = first.where(F.col("page").isNull()).select("key", "square"), first.where("page = -1").select("key", "square")
    away = first.where("page >= 0")
    crowd = away.groupBy("page").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("batches"))
    batched = (
        away.join(crowd, "page")
        .groupBy("page", F.pmod(F.xxhash64("key"), F.col("batches")).alias("batch"))
        .agg(F.collect_list(F.struct("key", "x", "square")).alias("queries"))
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, queries = _rows(batch.column("rows").slice(i, 1), width), batch.column("queries")[i].values
                row, square = nearer(_rows(queries.field("x"), width), queries.field("square").to_numpy(), x, k)
                yield pa.RecordBatch.from_arrays([queries.field("key").take(pa.array(row)), pa.array(square)], names=["key", "square"])

    answers = pages.select("page", "rows").join(batched, "page").select("rows", "queries").mapInArrow(ask, f"key {key_type}, square double")
    # a row has at most k distances from each page it visited
    kth = F.element_at(F.sort_array(F.collect_list("square")), k)
    merged = mine.unionByName(answers).groupBy("key").agg(kth.alias("square"))
    found = settled.unionByName(merged).select(F.col("key").alias(key), F.sqrt("square").alias("distance"))
    return found.where(F.col("distance") < math.inf)


def _answers(keys: pa.Array, rows: np.ndarray, square: np.ndarray, x: np.ndarray | None = None, place: np.ndarray | None = None) -> pa.RecordBatch:
    """``keys`` of ``rows`` with their squares, and what they ask where, if they do."""
    asked = pa.nulls(len(rows), pa.binary()) if x is None else _binaries(x)
    where = pa.nulls(len(rows), pa.int64()) if place is None else pa.array(place)
    return pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), pa.array(square), asked, where], names=["key", "square", "x", "page"])


def knee(distances: DataFrame) -> tuple[float, int]:
    """The distance just before the largest jump in sorted order, and its place from 0; a zero is replaced by the smallest
    positive distance.

    A jump wider than one of ``KNEE_BUCKETS`` equal buckets lies between the ends of two of them. Otherwise the distances are ordered, in range buckets.
    """
    rows = cut_lineage(distances.select("distance"))
    whole = rows.agg(F.min("distance").alias("low"), F.max("distance").alias("high")).first()
    if whole["low"] is None:
        return 0.0, 0
    if whole["low"] == whole["high"]:  # a single value
        return float(whole["low"]), 0
    width = (whole["high"] - whole["low"]) / KNEE_BUCKETS
    ends = (
        rows.groupBy(F.floor((F.col("distance") - whole["low"]) / max(width, sys.float_info.min)).alias("bucket"))
        .agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("n"))
        .orderBy("bucket")
        .toPandas()  # KNEE_BUCKETS + 1 at most
    )
    jumps = ends["low"].to_numpy()[1:] - ends["high"].to_numpy()[:-1]
    widest = int(jumps.argmax()) if len(jumps) else 0
    if len(jumps) and jumps[widest] > width * (1 + 1e-6):
        eps, at = float(ends["high"][widest]), int(ends["n"][: widest + 1].sum()) - 1
    else:
        eps = _ordered_knee(rows)
        at = rows.where(F.col("distance") <= eps).count() - 1
    if eps == 0:
        eps = rows.where("distance > 0").agg(F.min("distance")).first()[0] or 0.0
    return eps, at


def _ordered_knee(rows: DataFrame) -> float:
    """The value before the largest jump. Jumps are found inside range buckets, and between them from the buckets' ends."""
    bucketed = with_bucket(rows, "distance", range_bounds(rows, "distance"))
    values = bucketed.select("bucket", "distance").distinct()
    after = F.lead("distance").over(Window.partitionBy("bucket").orderBy("distance"))
    inner = F.struct((after - F.col("distance")).alias("jump"), (-F.col("distance")).alias("from"))
    ends = (
        values.withColumn("inner", inner)
        .groupBy("bucket")
        .agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("inner").alias("inner"))
        .orderBy("bucket")
        .collect()  # one row per range bucket
    )
    jumps = [(r["inner"]["jump"], r["inner"]["from"]) for r in ends if r["inner"]["jump"] is not None]
    jumps += [(b["low"] - a["high"], -a["high"]) for a, b in zip(ends, ends[1:])]
    return -max(jumps)[1] + 0.0
