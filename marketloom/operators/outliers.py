"""Outlier detection on a price column, and on several columns together."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import special as S
from marketloom.operators.blocks import gather, monomials, pack, total
from marketloom.operators.groups import sample_rows, union_batches
from marketloom.operators.lookup import bounded_local
from marketloom.operators.ranks import exact_quantiles, quantile_table, usable, value_ladder
from marketloom.session import cut_lineage

PRICE = "price_min"


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.where(usable(F.col(column).cast("double")))


def _quantiles(df: DataFrame, value: str, named: dict[str, float]) -> dict[str, float] | None:
    """Exact quantiles as driver scalars; None when there is no value."""
    row = quantile_table(df, value, named).first()
    return None if row is None or row["n"] is None else row.asDict()


def _pct(count: Column) -> Column:
    return F.try_divide(count * 100, F.col("n"))


def _outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


# --- rules on one column -----------------------------------------------------------------------------------------------


def _iqr_fences(df: DataFrame, column: str) -> dict[str, float] | None:
    q = _quantiles(df, column, {"q1": 0.25, "q3": 0.75})
    if q is None:
        return None
    iqr = q["q3"] - q["q1"]
    return {
        "q1": q["q1"],
        "q3": q["q3"],
        "iqr": iqr,
        "lower_bound": q["q1"] - 1.5 * iqr,
        "upper_bound": q["q3"] + 1.5 * iqr,
        "extreme_lower": q["q1"] - 3 * iqr,
        "extreme_upper": q["q3"] + 3 * iqr,
    }


def outliers_iqr(df: DataFrame, column: str = PRICE) -> DataFrame:
    """Values strictly outside 1.5 quartile ranges, and outside 3."""
    f = _iqr_fences(df, column) or dict.fromkeys(
        ("q1", "q3", "iqr", "lower_bound", "upper_bound", "extreme_lower", "extreme_upper"), math.nan
    )
    names = ("q1", "q3", "iqr", "lower_bound", "upper_bound")
    return (
        _values(df, column)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(_outside(column, f["lower_bound"], f["upper_bound"])).alias("outlier_count"),
            F.count_if(_outside(column, f["extreme_lower"], f["extreme_upper"])).alias("extreme_outlier_count"),
        )
        .where("n > 0")
        .select(
            *[F.lit(f[name]).alias(name) for name in names],
            "outlier_count",
            _pct(F.col("outlier_count")).alias("outlier_percentage"),
            "extreme_outlier_count",
        )
    )


def _population(df: DataFrame, column: str) -> tuple[float, float] | None:
    row = _values(df, column).agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("sd")).first()
    return None if not row["sd"] else (row["mean"], row["sd"])


def _zscore(column: str, centre: tuple[float, float] | None) -> Column:
    return F.lit(None).cast("double") if centre is None else F.abs(F.col(column) - centre[0]) / centre[1]


def outliers_zscore(df: DataFrame, column: str = PRICE) -> DataFrame:
    """Values beyond two and three population standard deviations; a constant column has none."""
    z = _zscore(column, _population(df, column))
    return (
        _values(df, column)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(z > 2).alias("outliers_2sigma"),
            F.count_if(z > 3).alias("outliers_3sigma"),
        )
        .where("n > 0")
        .select(
            "outliers_2sigma",
            "outliers_3sigma",
            _pct(F.col("outliers_2sigma")).alias("percentage_2sigma"),
            _pct(F.col("outliers_3sigma")).alias("percentage_3sigma"),
        )
    )


def _median_mad(df: DataFrame, column: str) -> tuple[float, float] | None:
    """Median and median absolute deviation; None when the deviation is 0."""
    m = _quantiles(df, column, {"median": 0.5})
    if m is None:
        return None
    gap = _values(df, column).select(F.abs(F.col(column) - m["median"]).alias("gap"))
    mad = _quantiles(gap, "gap", {"mad": 0.5})["mad"]
    return (m["median"], mad) if mad > 0 else None


def _modified_z(column: str, centre: tuple[float, float] | None) -> Column:
    if centre is None:
        return F.lit(None).cast("double")
    return F.abs(0.6745 * (F.col(column) - centre[0]) / centre[1])


def outliers_mad(df: DataFrame, column: str = PRICE) -> DataFrame:
    """Modified z-scores beyond 3.5; no row when the deviation is 0."""
    centre = _median_mad(df, column)
    counted = _values(df, column).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_modified_z(column, centre) > 3.5).alias("outlier_count")
    )
    return counted.where(F.lit(centre is not None)).select(
        F.lit(centre and centre[0]).cast("double").alias("median"),
        F.lit(centre and centre[1]).cast("double").alias("mad"),
        "outlier_count",
        _pct(F.col("outlier_count")).alias("outlier_percentage"),
    )


def anomaly_flags(df: DataFrame, column: str = PRICE, key: str = "id") -> DataFrame:
    """Row flags of the three rules; a rule that cannot run flags nothing."""
    f = _iqr_fences(df, column)
    flag = lambda test: F.coalesce(test, F.lit(False))
    return _values(df, column).select(
        key,
        flag(_outside(column, f["lower_bound"], f["upper_bound"]) if f else F.lit(False)).alias("is_iqr_outlier"),
        flag(_zscore(column, _population(df, column)) > 3).alias("is_zscore_outlier"),
        flag(_modified_z(column, _median_mad(df, column)) > 3.5).alias("is_mad_outlier"),
    )


# --- isolation forest ----------------------------------------------------------------------------------------------------

TREES = 100
TREE_ROWS = 256
CONTAMINATIONS = (0.05, 0.10, 0.15)


def _path_length(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow_tree(columns: list[str], pdf: pd.DataFrame) -> pd.DataFrame:
    """One isolation tree over at most 256 rows, as a table of nodes; a leaf has no feature."""
    tree = int(pdf["tree"].iloc[0])
    points = pdf.sort_values(["_order"])[columns].to_numpy(dtype=float)
    rng = np.random.default_rng(tree)
    deepest = math.ceil(math.log2(max(len(points), 2)))
    nodes: list[list[float]] = []
    stack = [(points, 0, -1, 0)]
    while stack:
        part, depth, parent, side = stack.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = me
        low, high = part.min(axis=0), part.max(axis=0)
        open_to_split = np.flatnonzero(high > low)
        if depth >= deepest or len(part) < 2 or not len(open_to_split):
            nodes.append([me, -1, 0.0, -1, -1, depth + float(_path_length(np.array(len(part))))])
            continue
        feature = int(rng.choice(open_to_split))
        cut = rng.uniform(low[feature], high[feature])
        nodes.append([me, feature, cut, -1, -1, 0.0])
        left = part[:, feature] <= cut
        stack.append((part[~left], depth + 1, me, 1))
        stack.append((part[left], depth + 1, me, 0))
    out = pd.DataFrame(nodes, columns=["node", "feature", "cut", "left", "right", "length"])
    return out.astype({"node": "int32", "feature": "int32", "left": "int32", "right": "int32"}).assign(tree=tree)


def _grow_forest(rows: DataFrame, columns: Sequence[str], key: str) -> tuple[list[dict[str, np.ndarray]], int]:
    """Trees grown in parallel on repeatable samples; the node tables, at most 511 rows a tree, come to the driver."""
    wanted = TREES * TREE_ROWS
    pool = cut_lineage(sample_rows(rows.select(key, *columns), wanted, key))
    held = pool.count()
    # The pool, a fixed number of rows at most, is dealt in turn: each tree takes the next rows, from the start again at the end.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64(key), key)) - 1
    mine = F.filter(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.pmod(F.col("_order") - t * TREE_ROWS, F.lit(max(held, 1))) < min(TREE_ROWS, held),
    )
    drawn = pool.withColumn("_order", place).withColumn("tree", F.explode(mine))
    names = list(columns)
    nodes = (
        drawn.groupBy("tree")
        .applyInPandas(
            lambda pdf: _grow_tree(names, pdf),
            "node int, feature int, cut double, left int, right int, length double, tree int",
        )
        .toPandas()
        .sort_values(["tree", "node"])
    )
    forest = [{c: t[c].to_numpy() for c in ("feature", "cut", "left", "right", "length")} for _, t in nodes.groupby("tree")]
    size = min(TREE_ROWS, rows.limit(TREE_ROWS).count())
    return forest, size


def _mean_length(forest: list[dict[str, np.ndarray]], points: np.ndarray) -> np.ndarray:
    total = np.zeros(len(points))
    for t in forest:
        at = np.zeros(len(points), dtype=np.int64)
        while True:
            feature = t["feature"][at]
            moving = np.flatnonzero(feature >= 0)
            if not len(moving):
                break
            here = at[moving]
            left = points[moving, feature[moving]] <= t["cut"][here]
            at[moving] = np.where(left, t["left"][here], t["right"][here])
        total += t["length"][at]
    return total / len(forest)


def isolation_scores(df: DataFrame, columns: Sequence[str] = (PRICE,), key: str = "id") -> DataFrame:
    """Score of each row, 2^(-mean path / expected path); higher is more isolated.

    For one column the whole forest is a step function of the value, so a row costs one binary search.
    """
    rows = reduce(_values, columns, df).select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    forest, size = _grow_forest(rows, columns, key)
    scale = float(_path_length(np.array(size))) or 1.0
    names = list(columns)
    if len(names) == 1 and forest:
        cuts = np.unique(np.concatenate([t["cut"][t["feature"] >= 0] for t in forest]))
        # A value equal to a cut goes left, so each step is closed on its right end.
        probes = np.append(cuts, np.inf)[:, None]
        steps = _mean_length(forest, probes)

        def length(points: np.ndarray) -> np.ndarray:
            return steps[np.searchsorted(cuts, points[:, 0], side="left")]
    else:

        def length(points: np.ndarray) -> np.ndarray:
            return _mean_length(forest, points)

    def score(batches):
        for pdf in batches:
            points = pdf[names].to_numpy(dtype=float)
            yield pd.DataFrame({key: pdf[key], "score": np.exp2(-length(points) / scale)})

    return rows.mapInPandas(score, f"{key} long, score double")


def outliers_iforest(
    df: DataFrame,
    columns: Sequence[str] = (PRICE,),
    contaminations: Sequence[float] = CONTAMINATIONS,
    key: str = "id",
) -> DataFrame:
    """Counts per contamination; the forest is grown and scored once for all of them."""
    normality = cut_lineage(isolation_scores(df, columns, key).select((-F.col("score")).alias("s")))
    cuts = {r["p"]: r["quantile"] for r in exact_quantiles(normality, "s", contaminations).collect()}
    counts = [F.count_if(F.col("s") < cuts.get(c, math.nan)).alias(f"{c}") for c in contaminations]
    totals = normality.agg(F.count("s").alias("n"), *counts)
    cells = [F.struct(F.lit(c).alias("contamination"), F.col(f"`{c}`").alias("outlier_count")) for c in contaminations]
    return (
        totals.where("n > 0")
        .select("n", F.inline(F.array(*cells)))
        .select("contamination", "outlier_count", _pct(F.col("outlier_count")).alias("outlier_percentage"))
    )


# --- local outlier factor ------------------------------------------------------------------------------------------------

LOF_BLOCK = 20_000


def _block_factors(k: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """Factors of the home values of one block of neighbouring sorted values."""
    pdf = pdf.sort_values("value")
    copies = pdf["copies"].to_numpy()
    x = np.repeat(pdf["value"].to_numpy(dtype=float), copies)
    first = np.cumsum(copies) - copies
    n = len(x)
    # Only a table of at most k rows has fewer neighbours to offer.
    k = max(min(k, n - 1), 0)
    if k == 0:
        return pd.DataFrame({"value": pdf["value"], "ties": pdf["ties"], "lof": 1.0})
    # The k nearest neighbours of a sorted value are among the k places on either side of it.
    place = np.arange(n)[:, None]
    around = place + np.concatenate([np.arange(-k, 0), np.arange(1, k + 1)])[None, :]
    gap = np.where((around >= 0) & (around < n), np.abs(x[np.clip(around, 0, n - 1)] - x[:, None]), np.inf)
    nearest = np.argsort(gap, axis=1, kind="stable")[:, :k]
    neighbour = np.take_along_axis(around, nearest, axis=1)
    distance = np.take_along_axis(gap, nearest, axis=1)
    k_distance = distance.max(axis=1)
    density = 1 / (np.maximum(k_distance[neighbour], distance).mean(axis=1) + 1e-10)
    factor = density[neighbour].mean(axis=1) / density
    out = pd.DataFrame({"value": pdf["value"].to_numpy(), "ties": pdf["ties"].to_numpy(), "lof": factor[first]})
    return out[pdf["home"].to_numpy()]


def lof_factors(df: DataFrame, column: str = PRICE, k: int = 20) -> DataFrame:
    """Exact local outlier factor of each distinct value of one column, with its count.

    On a line the neighbours of a value are next to it in sorted order, so sorted positions are cut into blocks that
    carry a margin wide enough for the neighbours of neighbours of neighbours. More than k + 1 copies of one value
    change nothing, so only that many take up positions.
    """
    margin = 4 * (k + 1)
    block = lambda place: F.floor(place / LOF_BLOCK)
    spread = (
        value_ladder(df, column, cap=k + 1)
        .withColumn("copies", F.least("ties", F.lit(k + 1).cast("long")))
        .withColumn("home_block", block(F.col("start")))
        .withColumn(
            "block",
            F.explode(
                F.sequence(
                    block(F.greatest(F.col("start") - margin, F.lit(0))),
                    block(F.col("start") + F.col("copies") + margin),
                )
            ),
        )
        .withColumn("home", F.col("block") == F.col("home_block"))
    )
    return (
        spread.select("block", "value", "ties", "copies", "home")
        .groupBy("block")
        .applyInPandas(lambda pdf: _block_factors(k, pdf), "value double, ties long, lof double")
    )


def outliers_lof(df: DataFrame, column: str = PRICE, k: int = 20, contamination: float = 0.1) -> DataFrame:
    """Count of values below the contamination quantile of the negated factor; needs at least k values."""
    total = _values(df, column).count()
    schema = "n_neighbors int, contamination double, outlier_count long, outlier_percentage double"
    if total < k:
        return df.sparkSession.createDataFrame([], schema)
    factors = cut_lineage(lof_factors(df, column, k).select((-F.col("lof")).alias("s"), "ties"))
    cut = exact_quantiles(factors, "s", [contamination], weight="ties").first()["quantile"]
    return factors.agg(
        F.sum("ties").alias("n"), F.coalesce(F.sum(F.when(F.col("s") < cut, F.col("ties"))), F.lit(0)).alias("outlier_count")
    ).select(
        F.lit(k).alias("n_neighbors"),
        F.lit(contamination).alias("contamination"),
        "outlier_count",
        _pct(F.col("outlier_count")).alias("outlier_percentage"),
    )


# --- robust covariance ---------------------------------------------------------------------------------------------------

GROUP_ROWS = 1500
GROUP_STARTS = 50
POOL = 32
FINALISTS = 5
C_STEPS = 20
BINS = 2048  # of the logarithm of a squared distance
BIN_RANGE = (-40.0, 40.0)
SEED = 42


def _mahalanobis(columns: Sequence[str], location: np.ndarray, precision: np.ndarray) -> Column:
    gaps = [F.col(c) - float(m) for c, m in zip(columns, location)]
    terms = [
        gaps[i] * gaps[j] * float(precision[i, j]) for i in range(len(columns)) for j in range(len(columns))
    ]
    return reduce(Column.__add__, terms)


def _location_scatter(rows: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = rows.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    scatter = np.zeros((len(columns),) * 2)
    for i, j in pairs:
        scatter[i, j] = scatter[j, i] = row[f"c{i}_{j}"]
    return np.array([row[f"m{i}"] for i in range(len(columns))]), scatter


def _squares(x: np.ndarray, location: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    """candidate x row: squared distances from each candidate's location in its scatter."""
    gap = x[None, :, :] - location[:, None, :]
    return np.einsum("cni,cij,cnj->cn", gap, np.linalg.pinv(scatter, hermitian=True), gap)


def _from_sums(sums: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Locations and scatters from sums of monomials (candidate x monomial)."""
    i, j = np.triu_indices(d)
    location = sums[:, 1 : 1 + d] / sums[:, :1]
    scatter = np.zeros((len(sums), d, d))
    scatter[:, i, j] = scatter[:, j, i] = sums[:, 1 + d :] / sums[:, :1] - location[:, i] * location[:, j]
    return location, scatter


def _ranked(location: np.ndarray, scatter: np.ndarray, keep: int) -> np.ndarray:
    """Rows (determinant, location, scatter) of the candidates with the lowest positive determinants."""
    rows = np.concatenate([np.linalg.det(scatter)[:, None], location, scatter.reshape(len(scatter), -1)], 1)
    rows = rows[np.isfinite(rows[:, 0]) & (rows[:, 0] > 1e-14)]
    return rows[np.argsort(rows[:, 0], kind="stable")[:keep]]


def _group_starts(x: np.ndarray, w: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    """The best candidates of one group of rows: random smallest subsets, two concentration steps each."""
    n, d = x.shape
    if n <= d + 1:
        return np.zeros((0, 1 + d + d * d))
    terms, whole = monomials(x), w.sum()
    chosen = np.stack([rng.choice(n, d + 1, replace=False) for _ in range(GROUP_STARTS)])
    sums = terms[chosen].sum(1)
    for _ in range(2):
        location, scatter = _from_sums(sums, d)
        order = np.argsort(_squares(x, location, scatter), axis=1, kind="stable")
        before = np.cumsum(w[order], axis=1) - w[order]
        mask = np.zeros(order.shape)
        np.put_along_axis(mask, order, np.where(before < share * whole, w[order], 0.0), 1)
        sums = mask @ terms
    return _ranked(*_from_sums(sums, d), FINALISTS)


def _concentrated(blocks: DataFrame, d: int, pool: np.ndarray, centre: np.ndarray, half: float) -> np.ndarray:
    """One concentration step of every candidate over all rows, in one pass.

    Each candidate's rows are summed by bins of their distance; the bins up to ``half`` rows make the next candidate, the last of
    them in proportion.
    """
    low, high = BIN_RANGE
    location, scatter = pool[:, 1 : 1 + d], pool[:, 1 + d :].reshape(-1, d, d)
    size = len(pool)

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        x = (x - centre[0]) / centre[1]
        terms = monomials(x) * w[:, None]
        square = _squares(x, location, scatter)
        bins = np.clip(((np.log2(np.maximum(square, 1e-300)) - low) * (BINS / (high - low))).astype(np.int64), 0, BINS - 1)
        place = (bins + np.arange(size)[:, None] * BINS).reshape(-1)
        return np.stack([np.bincount(place, weights=np.tile(t, size), minlength=size * BINS) for t in terms.T], 1)

    found = total(blocks, d, kernel).reshape(size, BINS, -1)
    counts = np.cumsum(found[:, :, 0], axis=1)
    share = np.clip((half - (counts - found[:, :, 0])) / np.maximum(found[:, :, 0], 1e-300), 0.0, 1.0)
    return _ranked(*_from_sums((found * share[:, :, None]).sum(1), d), size)


def minimum_covariance(rows: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray] | None:
    """Location and scatter of the half of the rows whose scatter has the lowest determinant; None when no scatter can be found.

    The nested search: all rows are dealt into groups of about ``GROUP_ROWS``; in each, ``GROUP_STARTS`` random smallest subsets take two
    concentration steps on the group, and the best of all groups form a pool. The pool takes two steps over all rows, its
    ``FINALISTS`` go on until the determinant stops falling.
    """
    d = len(columns)
    blocks = pack(rows, columns)
    sums = total(blocks, d, lambda x, w: (monomials(x) * w[:, None]).sum(0)[None, :])
    n = 0 if sums is None else sums[0, 0]
    if n < 10:
        return None
    mean = sums[0, 1 : 1 + d] / n
    spread = np.sqrt(total(blocks, d, lambda x, w: (((x - mean) ** 2) * w[:, None]).sum(0)[None, :])[0] / n)
    if not (spread > 0).all():
        return None
    centre = np.stack([mean, spread])
    half = (n + d + 1) // 2

    def step(state, x, w, rng):
        x = (x - centre[0]) / centre[1]
        deal = rng.permutation(len(x))
        for part in np.array_split(deal, max(1, round(len(x) / GROUP_ROWS))):
            found = _group_starts(x[part], w[part], half / n, rng)
            state = found if state is None else merge(state, found)
        return state

    def merge(a, b):
        both = np.concatenate([a, b])
        return both[np.argsort(both[:, 0], kind="stable")[:POOL]]

    pool = gather(blocks, d, step, merge, seed=SEED)
    for turn in range(C_STEPS):
        if not len(pool):
            return None
        best = pool[0, 0]
        pool = _concentrated(blocks, d, pool, centre, half)
        if turn == 1:
            pool = pool[:FINALISTS]
        if turn > 1 and (not len(pool) or pool[0, 0] >= best * (1 - 1e-6)):
            break
    if not len(pool):
        return None
    scatter = pool[0, 1 + d :].reshape(d, d) * np.outer(spread, spread)
    return mean + spread * pool[0, 1 : 1 + d], scatter


def reweighted(rows: DataFrame, columns: Sequence[str], location: np.ndarray, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Location and scatter of the rows within the 97.5 % ellipse, after the scatter is made consistent at the normal model by the median
    distance."""
    d = len(columns)
    distance = rows.withColumn("_d", _mahalanobis(columns, location, np.linalg.inv(scatter)))
    median = exact_quantiles(distance, "_d", [0.5]).first()["quantile"]
    scatter = scatter * (median / S.chi2_upper_quantile(0.5, d))
    distance = rows.withColumn("_d", _mahalanobis(columns, location, np.linalg.inv(scatter)))
    return _location_scatter(distance.where(F.col("_d") < S.chi2_upper_quantile(0.025, d)), columns)


def _complete(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    return reduce(_values, columns, df).select(key, *[F.col(c).cast("double").alias(c) for c in columns])


def robust_distances(df: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame | None:
    """Squared robust distance of each row (reweighted minimum covariance determinant); None when no scatter can be found."""
    rows = _complete(df, columns, key)
    found = minimum_covariance(rows, columns)
    if found is None:
        return None
    location, scatter = reweighted(rows, columns, *found)
    if not np.linalg.det(scatter) > 0:
        return None
    return rows.select(key, _mahalanobis(columns, location, np.linalg.inv(scatter)).alias("distance"))


def robust_reweighting(df: DataFrame, columns: Sequence[str] = ("price_min", "price_max"), key: str = "id") -> DataFrame:
    """(element, value) of location and scatter after one reweighting that starts at the medians and the median absolute deviations."""
    rows = _complete(df, columns, key)
    medians = [exact_quantiles(rows, c, [0.5]).first() for c in columns]
    if any(m is None for m in medians):
        return df.sparkSession.createDataFrame([], "element string, value double")
    location = np.array([m["quantile"] for m in medians])
    gaps = rows.select(*[F.abs(F.col(c) - float(m)).alias(c) for c, m in zip(columns, location)])
    spread = np.array([exact_quantiles(gaps, c, [0.5]).first()["quantile"] for c in columns]) * 1.4826
    if not (spread > 0).all():
        return df.sparkSession.createDataFrame([], "element string, value double")
    location, scatter = reweighted(rows, columns, location, np.diag(spread**2))
    out = [(f"location {c}", float(m)) for c, m in zip(columns, location)]
    out += [(f"scatter {a} {b}", float(scatter[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j]
    return df.sparkSession.createDataFrame(out, "element string, value double")


def outliers_elliptic(
    df: DataFrame, columns: Sequence[str] = ("price_min", "price_max"), contamination: float = 0.1, key: str = "id"
) -> DataFrame:
    """Count of rows beyond the contamination quantile of the robust distance; no row when the fit fails."""
    schema = "contamination double, outlier_count long, outlier_percentage double"
    distances = robust_distances(df, columns, key)
    if distances is None:
        return df.sparkSession.createDataFrame([], schema)
    scored = distances.select((-F.col("distance")).alias("s"))
    cut = exact_quantiles(scored, "s", [contamination]).first()["quantile"]
    return scored.agg(F.count("s").alias("n"), F.count_if(F.col("s") < cut).alias("outlier_count")).select(
        F.lit(contamination).alias("contamination"),
        "outlier_count",
        _pct(F.col("outlier_count")).alias("outlier_percentage"),
    )


# --- comparison ------------------------------------------------------------------------------------------------------------


def method_counts(df: DataFrame, methods: Sequence[str] = ("iqr", "modified_zscore")) -> DataFrame:
    """(method, outlier_count) of the chosen methods; the z-score rule counts its 3-sigma outliers."""
    runs = {
        "iqr": lambda: outliers_iqr(df).select(F.lit("iqr").alias("method"), "outlier_count"),
        "zscore": lambda: outliers_zscore(df).select(F.lit("zscore").alias("method"), F.col("outliers_3sigma").alias("outlier_count")),
        "modified_zscore": lambda: outliers_mad(df).select(F.lit("modified_zscore").alias("method"), "outlier_count"),
        "isolation_forest": lambda: outliers_iforest(df).select(
            F.format_string("isolation_forest_%.0fpct", F.col("contamination") * 100).alias("method"), "outlier_count"
        ),
        "lof": lambda: outliers_lof(df).select(F.lit("lof").alias("method"), "outlier_count"),
        "elliptic_envelope": lambda: outliers_elliptic(df).select(F.lit("elliptic_envelope").alias("method"), "outlier_count"),
    }
    return union_batches([runs[m]() for m in methods])


def outlier_comparison(df: DataFrame, methods: Sequence[str] = ("iqr", "modified_zscore")) -> DataFrame:
    counts = method_counts(df, methods)
    return counts.agg(
        F.count(F.lit(1)).alias("methods"),
        F.avg("outlier_count").alias("average_outliers"),
        F.max("outlier_count").alias("max_outliers"),
        F.min("outlier_count").alias("min_outliers"),
    )
