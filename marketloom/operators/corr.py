"""Correlation matrices in long form (column_a, column_b, ...)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import special as S
from marketloom.operators.ranks import average_rank, melt, range_bounds, usable, value_ladder, with_bucket
from marketloom.session import cut_lineage

STRONG = 0.7


def _numeric(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """The columns as doubles with NaN as missing."""
    missing = F.lit(None).cast("double")
    return df.select(*ids, *[F.nanvl(F.col(c).cast("double"), missing).alias(c) for c in columns])


def _pair_rows(df: DataFrame, pairs: Sequence[tuple[str, str]], measures: dict[str, object]) -> DataFrame:
    """One aggregation over all pairs, turned into one row per pair."""
    cells = [
        F.struct(
            F.lit(a).alias("column_a"),
            F.lit(b).alias("column_b"),
            *[measure(F.col(a), F.col(b)).alias(name) for name, measure in measures.items()],
        )
        for a, b in pairs
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _mirrored(upper: DataFrame, values: Sequence[str]) -> DataFrame:
    """Upper triangle with diagonal -> full matrix."""
    lower = upper.where("column_a != column_b").select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), *values
    )
    return upper.select("column_a", "column_b", *values).unionByName(lower)


def _triangle(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i:]]


def _both(a: Column, b: Column) -> Column:
    return F.count(F.when(a.isNotNull() & b.isNotNull(), 1))


def _pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete correlation; undefined is null, as for a column of one value."""
    deviation = lambda c: F.stddev_pop(F.when(a.isNotNull() & b.isNotNull(), c))
    r = F.try_divide(F.covar_pop(a, b), deviation(a) * deviation(b))
    return F.when((_both(a, b) > 2) & r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _pearson_upper(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = {"n": _both, "r": _pearson}
    return _pair_rows(_numeric(df, columns), _triangle(columns), measures)


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete r with its two-sided p; fewer than three pairs give null."""
    upper = _pearson_upper(df, columns).withColumn("p_value", S.correlation_p(F.col("r"), F.col("n").cast("double")))
    return _mirrored(upper, ["n", "r", "p_value"])


def strong_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs beyond +-0.7, strictly."""
    r = F.col("r")
    return (
        _pearson_upper(df, columns)
        .where((F.col("column_a") != F.col("column_b")) & (F.abs(r) > STRONG))
        .select("column_a", "column_b", "r", F.when(r > 0, "positive").otherwise("negative").alias("direction"))
    )


def correlation_heatmap(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full matrix to two decimals; ``in_lower`` marks the cells of the lower-triangle picture."""
    place = F.create_map(*[part for i, c in enumerate(columns) for part in (F.lit(c), F.lit(i))])
    full = _mirrored(_pearson_upper(df, columns), ["r"])
    return full.select(
        "column_a",
        "column_b",
        F.round("r", 2).alias("r"),
        (place[F.col("column_a")] >= place[F.col("column_b")]).alias("in_lower"),
    )


def _ranked_corr(rows: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    # One ladder for all columns, stored, so the planner knows its size in each join.
    ladder = cut_lineage(value_ladder(melt(rows, columns), "value", ["column"]).withColumn("rank", average_rank()))
    ranked = rows
    for column in columns:
        own = ladder.where(F.col("column") == column)
        ranked = ranked.join(own.select(F.col("value").alias(column), F.col("rank").alias(f"{column}_rank")), column, "left")
    rho = lambda a, b: _pearson(F.col(f"{a}_rank"), F.col(f"{b}_rank"))
    cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), rho(a, b).alias("rho")) for a, b in pairs]
    return ranked.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation; each pair is ranked over the rows where both are present.

    Columns without missing values share one ranking; only pairs with a gap are ranked on their own.
    """
    rows = _numeric(df, columns)
    gaps = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    complete = [c for c in columns if gaps[c] == 0]
    parts = []
    shared = [pair for pair in _triangle(columns) if set(pair) <= set(complete)]
    if shared:
        parts.append(_ranked_corr(rows.select(*complete), shared))
    for a, b in _triangle(columns):
        if (a, b) not in shared:
            present = rows.select(*dict.fromkeys((a, b))).where(F.col(a).isNotNull() & F.col(b).isNotNull())
            parts.append(_ranked_corr(present, [(a, b)]))
    upper = parts[0]
    for part in parts[1:]:
        upper = upper.unionByName(part)
    return _mirrored(upper, ["rho"])


# --- Kendall ----------------------------------------------------------------------------------------------------------


#
# Both columns are cut into range buckets; a value heavy enough to be a bound has a bucket of its own. Two rows then differ in
# both buckets, share the first, or share the second only. The first kind is counted from the table of bucket counts, the others inside
# one bucket each, from distinct value pairs with their counts. A bucket of a single value has nothing to compare, so a
# value shared by a third of all rows costs nothing.

KENDALL_BUCKET_ROWS = 100_000
KENDALL_BUCKETS = 512


def _order_sum(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Sum over pairs of w * w * sign(dx) * sign(dy), by merge counting: one level for each bit of the rank of x."""
    x, y = (np.unique(v, return_inverse=True)[1].astype(np.int64) for v in (x, y))
    order = np.argsort(y, kind="stable")
    x, y, w = x[order], y[order], w[order]
    total, width = 0.0, int(y[-1]) + 1 if len(y) else 1
    for bit in range(int(x.max()).bit_length() if len(x) else 0):
        block, right = x >> (bit + 1), (x >> bit) & 1 == 1
        order = np.argsort(block, kind="stable")  # stays ordered by y inside a block
        place = block[order] * width + y[order]
        left = np.where(right[order], 0.0, w[order])
        upto = np.concatenate([[0.0], np.cumsum(left)])
        here = place[right[order]]
        own = here // width
        below = upto[np.searchsorted(place, here, "left")] - upto[np.searchsorted(place, own * width, "left")]
        above = upto[np.searchsorted(place, (own + 1) * width, "left")] - upto[np.searchsorted(place, here, "right")]
        total += float((w[order][right[order]] * (below - above)).sum())
    return total


def _grid_sum(cells: pd.DataFrame) -> float:
    """The same sum over pairs that differ in both buckets, from the counts of bucket pairs."""
    table = cells.pivot_table(index="a", columns="b", values="n", aggfunc="sum", fill_value=0).to_numpy(dtype=float)
    corner = np.zeros((table.shape[0] + 1, table.shape[1] + 1))
    corner[1:, 1:] = table.cumsum(0).cumsum(1)
    lower = corner[:-1, :-1]  # rows in earlier buckets of both
    higher = corner[:-1, -1:] - corner[:-1, 1:]  # earlier bucket of the first, later of the second
    return float((table * (lower - higher)).sum())


def _kendall_bounds(rows: DataFrame, column: str) -> list[float]:
    bounds = range_bounds(rows.where(F.col(column).isNotNull()), column, KENDALL_BUCKET_ROWS)
    step = -(-len(bounds) // KENDALL_BUCKETS)
    return bounds[:: max(step, 1)]


def _kendall_bucket(df: DataFrame, column: str, bounds: Sequence[float], name: str) -> DataFrame:
    """Bucket 2i lies between two bounds, bucket 2i + 1 holds the i-th bound alone."""
    cut = with_bucket(df, column, bounds)
    alone = F.col(column).isin(list(bounds)) if bounds else F.lit(False)
    return cut.withColumn(name, 2 * F.col("bucket") - alone.cast("int")).drop("bucket")


def _tau(rows: DataFrame, a: str, b: str, bounds: dict[str, list[float]]) -> float | None:
    both = rows.select(F.col(a).alias("x"), F.col(b).alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    cells = _kendall_bucket(_kendall_bucket(both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")), "x", bounds[a], "a"), "y", bounds[b], "b")
    cells = cut_lineage(cells)
    grid = cells.groupBy("a", "b").agg(F.sum("w").alias("n")).toPandas()  # at most (2 * KENDALL_BUCKETS + 1) squared rows
    n = float(grid["n"].sum())
    ties = lambda c: cells.groupBy(c).agg(F.sum("w").cast("double").alias("t")).agg(F.sum(F.col("t") * (F.col("t") - 1) / 2)).first()[0] or 0.0
    pairs = n * (n - 1) / 2
    room = (pairs - ties("x")) * (pairs - ties("y"))
    if not room > 0:
        return None
    first = cells.where(F.col("a") % 2 == 0).select(F.lit(0).alias("part"), F.col("a").alias("bucket"), F.col("x").alias("u"), F.col("y").alias("v"), "w")
    second = cells.where(F.col("b") % 2 == 0).select(
        F.lit(1).alias("part"), F.col("b").alias("bucket"), F.col("a").cast("double").alias("u"), F.col("y").alias("v"), "w"
    )

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"s": [_order_sum(pdf["u"].to_numpy(), pdf["v"].to_numpy(), pdf["w"].to_numpy(dtype=float))]})

    merged = first.unionByName(second).groupBy("part", "bucket", "u", "v").agg(F.sum("w").alias("w"))
    local = merged.groupBy("part", "bucket").applyInPandas(inside, "s double").agg(F.sum("s")).first()[0] or 0.0
    return (local + _grid_sum(grid)) / float(np.sqrt(room))


def kendall_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """tau-b of every pair of columns over all rows where both are present; undefined is null."""
    rows = _numeric(df, columns)
    bounds = {c: _kendall_bounds(rows, c) for c in columns}
    found = [(a, b, _tau(rows, a, b, bounds)) for a, b in combinations(columns, 2)]
    return df.sparkSession.createDataFrame(found, "column_a string, column_b string, tau double")


def kendall_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full matrix of tau-b over all rows; the diagonal is 1 for a column of several values, else null."""
    rows = _numeric(df, columns)
    distinct = rows.agg(*[(F.min(c) < F.max(c)).alias(c) for c in columns]).first()
    ones = [(c, c, 1.0 if distinct[c] else None) for c in columns]
    diagonal = df.sparkSession.createDataFrame(ones, "column_a string, column_b string, tau double")
    return _mirrored(diagonal.unionByName(kendall_pairs(df, columns)), ["tau"])


# --- partial correlation ------------------------------------------------------------------------------------------------


def partial_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of each pair given all other columns, over complete rows.

    Equal to the correlation of least-squares residuals, read off the inverse covariance matrix. Needs at least three
    columns and ten rows; constant columns are left out of the result.
    """
    schema = "column_a string, column_b string, partial_r double"
    columns = list(columns)
    present = _numeric(df, columns)
    for c in columns:
        present = present.where(usable(F.col(c)))
    pairs = _triangle(columns)
    m = present.agg(
        F.count(F.lit(1)).alias("n"), *[F.covar_samp(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)]
    ).first()
    if len(columns) < 3 or m["n"] < 10:
        return df.sparkSession.createDataFrame([], schema)
    cov = np.zeros((len(columns), len(columns)))
    for i, (a, b) in enumerate(pairs):
        j, k = columns.index(a), columns.index(b)
        cov[j, k] = cov[k, j] = m[f"{i}"]
    spread = np.sqrt(np.diag(cov))
    varying = [i for i in range(len(columns)) if spread[i] > 0]
    scaled = cov[np.ix_(varying, varying)] / np.outer(spread[varying], spread[varying])
    precision = np.linalg.pinv(scaled, hermitian=True)
    out = []
    for (p, i), (q, j) in combinations(enumerate(varying), 2):
        room = precision[p, p] * precision[q, q]
        out.append((columns[i], columns[j], float(-precision[p, q] / np.sqrt(room)) if room > 0 else None))
    return df.sparkSession.createDataFrame(out, schema)
