"""Clusterings of a scaled feature matrix, their quality, and segment profiles.

A feature matrix is a DataFrame with a key and one double column per feature.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators import mixtures, ward
from marketloom.operators.blocks import all_final, cell_sums, finalists, hopeless, pack, square_gaps, starts, total, weighted_draws
from marketloom.operators.groups import topk_per_group, union_batches
from marketloom.operators.lookup import LOOKUP_ROWS, lookup_join
from marketloom.operators.mixtures import principal
from marketloom.operators.ranks import melt, quantile_table
from marketloom.session import cut_lineage

SEED = 42
MAX_ITER = 300
KMEANS_TOLERANCE = 1e-4
STARTS = 10
K_RANGE = tuple(range(2, 11))
LEAVES = 2000
NEAREST_ROWS = 256


# --- quality of a labelling --------------------------------------------------------------------------------------------


def silhouettes(points, own_norm, rows, at, size, mean_norm, mean) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, squared distance, silhouette) of each row in cluster ``at``, from sizes, mean norms and means of all clusters."""
    square = ((points - mean[at]) ** 2).sum(axis=1)
    # Mean squared distance from each point to all members of each cluster.
    to_all = np.maximum(own_norm[:, None] + mean_norm[None, :] - 2 * points @ mean.T, 0)
    inside = to_all[rows, at] * size[at] / np.maximum(size[at] - 1, 1)
    to_all[rows, at] = np.inf
    nearest = to_all.min(axis=1)
    larger = np.maximum(inside, nearest)
    lone = (size[at] == 1) | ~np.isfinite(nearest) | (larger == 0)
    return np.sqrt(square), square, np.where(lone, 0.0, (nearest - inside) / np.where(lone, 1.0, larger))


def label_quality(df: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> pd.DataFrame:
    """Per labelling and cluster: size, mean, mean distance, squared error and mean silhouette.

    The silhouette uses squared distances, which need only the size, mean and mean square norm of each cluster. Two
    passes cover all labellings: one for those sums, one for the distances. The result has a row per cluster.
    """
    names = list(columns)
    wide = df.select(*names, F.explode(F.array(*[
        F.struct(F.lit(label).alias("labelling"), F.col(label).cast("long").alias("cluster")) for label in labels
    ])).alias("l")).select(*names, "l.*")
    norm = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    sums = (
        wide.groupBy("labelling", "cluster")
        .agg(F.count(F.lit(1)).alias("size"), F.avg(norm).alias("norm"), *[F.avg(c).alias(c) for c in names])
        .limit(LOOKUP_ROWS + 1)
        .toPandas()
        .sort_values(["labelling", "cluster"])
    )
    if len(sums) > LOOKUP_ROWS:
        raise ValueError(f"more than {LOOKUP_ROWS} clusters")
    tables = {
        label: (t["cluster"].to_numpy(), t["size"].to_numpy(dtype=float), t["norm"].to_numpy(), t[names].to_numpy())
        for label, t in sums.groupby("labelling")
    }

    def distances(batches):
        for pdf in batches:
            points = pdf[names].to_numpy(dtype=float)
            own_norm = (points**2).sum(axis=1)
            for label, (clusters, size, mean_norm, mean) in tables.items():
                at = np.searchsorted(clusters, pdf[label].to_numpy())
                dist, square, score = silhouettes(points, own_norm, np.arange(len(points)), at, size, mean_norm, mean)
                part = pd.DataFrame({"cluster": clusters[at], "dist": dist, "sse": square, "sil": score})
                out = part.groupby("cluster", as_index=False).sum()
                yield out.assign(labelling=label)[["labelling", "cluster", "dist", "sse", "sil"]]

    partial = df.select(*names, *[F.col(c).cast("long").alias(c) for c in labels]).mapInPandas(
        distances, "labelling string, cluster long, dist double, sse double, sil double"
    )
    totals = (
        partial.groupBy("labelling", "cluster")
        .agg(F.sum("dist").alias("dist"), F.sum("sse").alias("sse"), F.sum("sil").alias("sil"))
        .toPandas()
    )
    return sums.merge(totals, on=["labelling", "cluster"]).sort_values(["labelling", "cluster"], ignore_index=True)


def _scores(quality: pd.DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Inertia, silhouette, Calinski-Harabasz and Davies-Bouldin of one labelling; undefined is None."""
    size, mean = quality["size"].to_numpy(dtype=float), quality[list(columns)].to_numpy(dtype=float)
    n, k = size.sum(), len(size)
    out = {"n_clusters": k, "inertia": float(quality["sse"].sum())}
    if k < 2 or n <= k:
        return out | {"silhouette": None, "calinski_harabasz": None, "davies_bouldin": None}
    centre = (size[:, None] * mean).sum(axis=0) / n
    between = float((size * ((mean - centre) ** 2).sum(axis=1)).sum())
    within = out["inertia"]
    spread = quality["dist"].to_numpy() / size
    gaps = np.sqrt(((mean[:, None, :] - mean[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    with np.errstate(divide="ignore"):
        ratios = (spread[:, None] + spread[None, :]) / gaps
    return out | {
        "silhouette": float(quality["sil"].sum() / n),
        "calinski_harabasz": float(between / (k - 1) / (within / (n - k))) if within > 0 else 1.0,
        "davies_bouldin": float(ratios.max(axis=1).mean()),
    }


_SCORE_SCHEMA = (
    "n_clusters long, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double"
)


def _score_frame(df: DataFrame, rows: list[tuple], lead: str = "") -> DataFrame:
    return df.sparkSession.createDataFrame(rows, lead + _SCORE_SCHEMA)


def cluster_metrics(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Quality of a given labelling."""
    scores = _scores(label_quality(df, columns, [label]), columns)
    return _score_frame(df, [tuple(scores.values())])


# --- k-means -----------------------------------------------------------------------------------------------------------


def _nearest_centre(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = square_gaps(points, centres)
    at = gap.argmin(1)
    return at, gap[np.arange(len(points)), at]


def _kmeans_round(blocks: DataFrame, width: int, sets: list[np.ndarray]) -> list[np.ndarray]:
    """(n, cost, norm, sums...) by centre of one assignment of all rows to each set of centres, in one pass.

    The gaps to all centres of all sets are one matrix product, the sums by centre another.
    """
    stacked = np.concatenate(sets)
    ends = np.cumsum([len(c) for c in sets])

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        rows, norm = np.arange(len(x)), (x**2).sum(1)
        gap = square_gaps(x, stacked)
        share = np.zeros_like(gap)
        out = np.zeros((len(stacked), 3 + width))
        for own, end in zip(sets, ends):
            at = end - len(own) + gap[:, end - len(own) : end].argmin(1)
            share[rows, at] = w
            out[:, 1] += np.bincount(at, weights=w * np.maximum(norm + gap[rows, at], 0.0), minlength=len(stacked))
        out[:, [0, *range(2, 3 + width)]] = share.T @ np.concatenate([np.ones((len(x), 1)), norm[:, None], x], 1)
        return out

    found = total(blocks, width, kernel)
    return [found[end - len(own) : end] for own, end in zip(sets, ends)]


def _moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Centres at the means of their rows; a centre without rows stays where it is."""
    return np.where(sums[:, :1] > 0, sums[:, 3:] / np.maximum(sums[:, :1], 1), centres)


def _mean_variance(blocks: DataFrame, width: int) -> tuple[float, float]:
    """(rows, mean variance of the features)."""
    n, centre, _, _ = principal(blocks, width)
    if n == 0:
        return 0.0, 0.0
    return n, float(total(blocks, width, lambda x, w: (((x - centre) ** 2) * w[:, None]).sum(0)[None, :]).mean() / n)


def _on_cells(cells: np.ndarray, centres: np.ndarray, tolerance: float) -> tuple[np.ndarray, float]:
    """(centres, cost) after the rounds in which all rows of a cell go to the centre nearest to their mean; cells are (n, norm, sums...)."""
    mean, cost = cells[:, 2:] / cells[:, :1], math.inf
    for _ in range(MAX_ITER):
        at, gap = _nearest_centre(mean, centres)
        cost = float(cells[:, 1].sum() + cells[:, 0] @ gap)
        sums = np.zeros((len(centres), cells.shape[1]))
        np.add.at(sums, at, cells)
        new = np.where(sums[:, :1] > 0, sums[:, 2:] / np.maximum(sums[:, :1], 1), centres)
        moved, centres = float(((new - centres) ** 2).sum()), new
        if moved <= tolerance:
            break
    return centres, cost


def _best_on_cells(
    blocks: DataFrame, width: int, plans: list[tuple[int, int]], n: float, tolerance: float
) -> tuple[list[tuple[int, int]], dict[int, np.ndarray]]:
    """The starts of each k that go on over all rows, after all starts have converged on the sums of all rows by cell."""
    drawn = weighted_draws(blocks, width, SEED)
    cells = cell_sums(blocks, width, drawn[0], lambda x: np.concatenate([np.ones((len(x), 1)), (x**2).sum(1)[:, None], x], 1))
    found = [_on_cells(cells, own, tolerance) for own in starts(blocks, width, plans, SEED, drawn)]
    kept = finalists(plans, [cost for _, cost in found], n)
    return [plans[i] for i in kept], {j: found[i][0] for j, i in enumerate(kept)}


def _fit_kmeans(blocks: DataFrame, width: int, ks: Sequence[int], n_init: int) -> dict[int, np.ndarray]:
    """The centres of lowest cost over ``n_init`` starts, for each k; all starts of all k share every pass over the rows.

    Starts are seeded on points drawn over all rows in proportion to their cost. A start ends when the squared moves of its centres sum to at most
    1e-4 of the mean feature variance, after ``MAX_ITER`` rounds, or when another one of its k is out of its reach. On tables too large for
    ``n_init`` starts in every pass, all of them converge on sums by cell first and only the best of each k go on.
    """
    plans = [(k, start) for k in ks for start in range(n_init)]
    n, variance = _mean_variance(blocks, width)
    if all_final(plans, n):
        centres = dict(enumerate(starts(blocks, width, plans, SEED)))
    else:
        plans, centres = _best_on_cells(blocks, width, plans, n, KMEANS_TOLERANCE * variance)
    cost, gain = dict.fromkeys(centres, math.inf), {}
    active = set(centres) if blocks.limit(1).count() else set()
    for turn in range(1, MAX_ITER + 1):
        if not active:
            break
        order = sorted(active)
        for i, sums in zip(order, _kmeans_round(blocks, width, [centres[i] for i in order])):
            new = _moved(centres[i], sums)
            gain[i], cost[i] = cost[i] - float(sums[:, 1].sum()), float(sums[:, 1].sum())
            moved, centres[i] = float(((new - centres[i]) ** 2).sum()), new
            if moved <= KMEANS_TOLERANCE * variance:
                active.discard(i)
        if turn >= 3:
            active -= hopeless(plans, cost, gain, active)
    best = {k: min((i for i, p in enumerate(plans) if p[0] == k), key=lambda i: (cost[i], i)) for k in ks}
    return {k: centres[i] for k, i in best.items()}


def _centre_quality(blocks: DataFrame, columns: Sequence[str], fits: dict[str, np.ndarray]) -> pd.DataFrame:
    """What ``label_quality`` gives, for labellings by the nearest of given centres, in two passes over the blocks."""
    width, names = len(columns), list(columns)
    sets = list(fits.values())
    sums = _kmeans_round(blocks, width, sets)
    kept = [np.flatnonzero(s[:, 0] > 0) for s in sums]
    size = [s[at, 0] for s, at in zip(sums, kept)]
    norm = [s[at, 2] / n for s, at, n in zip(sums, kept, size)]
    mean = [s[at, 3:] / n[:, None] for s, at, n in zip(sums, kept, size)]
    ends = np.cumsum([len(n) for n in size])

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        out, rows, own_norm = np.zeros((int(ends[-1]), 3)), np.arange(len(x)), (x**2).sum(1)
        for i, (centres, at_kept) in enumerate(zip(sets, kept)):
            at = np.searchsorted(at_kept, square_gaps(x, centres).argmin(1))
            part = [w, *[w * v for v in silhouettes(x, own_norm, rows, at, size[i], norm[i], mean[i])]]
            for j, v in enumerate(part[1:]):
                out[ends[i] - len(at_kept) : ends[i], j] = np.bincount(at, weights=v, minlength=len(at_kept))
        return out

    found = total(blocks, width, kernel)
    tables = []
    for i, label in enumerate(fits):
        own = found[ends[i] - len(kept[i]) : ends[i]]
        table = pd.DataFrame(mean[i], columns=names).assign(labelling=label, cluster=kept[i], size=size[i], norm=norm[i])
        tables.append(table.assign(dist=own[:, 0], sse=own[:, 1], sil=own[:, 2]))
    return pd.concat(tables, ignore_index=True)


def with_cluster(df: DataFrame, columns: Sequence[str], centres: np.ndarray, label: str) -> DataFrame:
    """Add the number of each row's nearest centre."""

    @F.pandas_udf("int")
    def nearest(*values: pd.Series) -> pd.Series:
        points = np.stack([v.to_numpy(dtype=float) for v in values], 1)
        parts = [points[at : at + NEAREST_ROWS] for at in range(0, len(points), NEAREST_ROWS)]  # a part's distances fit a cache
        return pd.Series(np.concatenate([_nearest_centre(part, centres)[0] for part in parts] or [[]]).astype(np.int32))

    return df.withColumn(label, nearest(*[F.col(c) for c in columns]))


def kmeans_rounds(matrix: DataFrame, columns: Sequence[str], k: int = 5, rounds: int = 3, key: str = "id") -> DataFrame:
    """Size, cost and centre of each cluster after ``rounds`` rounds from the k rows of lowest key, without any draw."""
    first = matrix.orderBy(key).limit(k).select(*columns).collect()
    centres = np.array([[float(v) for v in r] for r in first]).reshape(len(first), len(columns))
    blocks = pack(matrix, columns)
    sums = np.zeros((0, 3))
    for _ in range(rounds if len(first) else 0):
        (sums,) = _kmeans_round(blocks, len(columns), [centres])
        centres = _moved(centres, sums)
    rows = [(i, int(s[0]), float(s[1]), *map(float, c)) for i, (s, c) in enumerate(zip(sums, centres))]
    schema = "cluster int, size long, cost double, " + ", ".join(f"{c} double" for c in columns)
    return matrix.sparkSession.createDataFrame(rows, schema)


def _argbest(values: list[float | None], best) -> int:
    known = [v for v in values if v is not None]
    return values.index(best(known)) if known else 0


def choose_k(ks: Sequence[int], inertia: list[float], silhouette: list, davies: list) -> tuple[int, int, int, int]:
    """(best, elbow, silhouette, Davies-Bouldin) choices; a tied vote goes to the smallest k."""
    bend = np.diff(np.diff(inertia))
    elbow = ks[int(np.argmin(bend)) + 2] if len(bend) else 3
    votes = [elbow, ks[_argbest(silhouette, max)], ks[_argbest(davies, min)]]
    best = min(set(votes), key=lambda k: (-votes.count(k), k))
    return best, *votes


def kmeans_selection(
    matrix: DataFrame, columns: Sequence[str], ks: Sequence[int] = K_RANGE, n_init: int = STARTS
) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(scores for each k, with flags for the k chosen by each criterion and by their vote; the centres of each k)."""
    blocks = pack(matrix, columns)
    fits = _fit_kmeans(blocks, len(columns), ks, n_init)
    quality = _centre_quality(blocks, columns, {f"k{k}": centres for k, centres in fits.items()})
    scores = [_scores(quality[quality["labelling"] == f"k{k}"], columns) for k in ks]
    best, elbow, silhouette, davies = choose_k(
        ks,
        [s["inertia"] for s in scores],
        [s["silhouette"] for s in scores],
        [s["davies_bouldin"] for s in scores],
    )
    rows = [
        (k, *s.values(), k == elbow, k == silhouette, k == davies, k == best) for k, s in zip(ks, scores)
    ]
    schema = "k long, " + _SCORE_SCHEMA + (
        ", is_elbow boolean, is_best_silhouette boolean, is_best_davies_bouldin boolean, is_chosen boolean"
    )
    return matrix.sparkSession.createDataFrame(rows, schema), fits


def kmeans_select_k(
    matrix: DataFrame, columns: Sequence[str], ks: Sequence[int] = K_RANGE, n_init: int = STARTS
) -> DataFrame:
    """Scores for each k, with flags for the k chosen by each criterion and by their vote."""
    return kmeans_selection(matrix, columns, ks, n_init)[0]


def kmeans_labels(matrix: DataFrame, columns: Sequence[str], k: int = 5, n_init: int = STARTS) -> DataFrame:
    """The matrix with its ``cluster``."""
    return with_cluster(matrix, columns, _fit_kmeans(pack(matrix, columns), len(columns), [k], n_init)[k], "cluster")


def kmeans_fit(matrix: DataFrame, columns: Sequence[str], k: int = 5, n_init: int = STARTS) -> DataFrame:
    """Size, share, silhouette and centre of each cluster, next to the scores of the whole clustering."""
    blocks = pack(matrix, columns)
    quality = _centre_quality(blocks, columns, {"k": _fit_kmeans(blocks, len(columns), [k], n_init)[k]})
    scores = _scores(quality, columns)
    n = quality["size"].sum()
    rows = [
        (
            int(q["cluster"]),
            int(q["size"]),
            float(q["size"] * 100 / n),
            float(q["sil"] / q["size"]),
            [float(q[c]) for c in columns],
            *scores.values(),
        )
        for _, q in quality.iterrows()
    ]
    lead = "cluster long, size long, percentage double, avg_silhouette double, center array<double>, "
    return _score_frame(matrix, rows, lead)


# --- hierarchical --------------------------------------------------------------------------------------------------------


def hierarchical_labels(
    matrix: DataFrame, columns: Sequence[str], k: int = 5, leaves: int = LEAVES
) -> DataFrame:
    """Ward clustering over clustering features: the rows are summarised in at most ``leaves`` features (as many as different rows, if
    fewer), the features are merged by Ward's criterion, and each row takes the group of its nearest feature."""
    found = ward.features(pack(matrix, columns), len(columns), leaves)
    if not len(found):
        return matrix.withColumn("hier_cluster", F.lit(None).cast("int"))
    size, centre = found[:, 0], found[:, 2:] / found[:, :1]
    order = np.lexsort(centre.T[::-1])
    group = ward.groups(size[order], centre[order], min(k, len(size)))
    nearest = with_cluster(matrix, columns, centre[order], "_leaf")
    label = F.element_at(F.array(*[F.lit(int(g)) for g in group]), F.col("_leaf") + 1)
    return nearest.withColumn("hier_cluster", label).drop("_leaf")


def hierarchical_cluster(matrix: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    # stored, as two passes over the labels follow
    labelled = cut_lineage(hierarchical_labels(matrix, columns, k).select(*columns, "hier_cluster"))
    return cluster_metrics(labelled, columns, "hier_cluster").withColumn("linkage_method", F.lit("ward"))


# --- principal components and mixtures -----------------------------------------------------------------------------------


def _centred(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    mean = matrix.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return matrix.withColumns({c: F.col(c) - mean[c] for c in columns})


def pca_scores(matrix: DataFrame, columns: Sequence[str], k: int = 2) -> tuple[DataFrame, list[float]]:
    """(matrix plus pca_1..pca_k, explained variance ratios); each component's largest loading is positive."""
    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(_centred(matrix, columns))
    model = PCA(k=k, inputCol="features", outputCol="_pca").fit(data)
    loadings = model.pc.toArray()
    sign = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    out = model.transform(data).withColumn("_pca", vector_to_array("_pca"))
    scores = {f"pca_{i + 1}": F.col("_pca")[i] * float(sign[i] or 1.0) for i in range(k)}
    return out.withColumns(scores).drop("_pca", "features"), [float(v) for v in model.explainedVariance.toArray()]


def pca(matrix: DataFrame, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """Explained and cumulative variance by component, with the number of components that reach 95 %.

    That number is null when the kept components do not reach it.
    """
    k = min(len(columns), 10) if k is None else k
    _, explained = pca_scores(matrix, columns, k)
    total = np.cumsum(explained)
    reached = np.flatnonzero(total >= 0.95)
    enough = int(reached[0]) + 1 if len(reached) else None
    rows = [(i + 1, float(e), float(t), enough) for i, (e, t) in enumerate(zip(explained, total))]
    return matrix.sparkSession.createDataFrame(
        rows, "component int, explained_variance double, cumulative_variance double, components_for_95_pct int"
    )


def gmm_selection(
    matrix: DataFrame, columns: Sequence[str], ks: Sequence[int] = K_RANGE, n_init: int = STARTS
) -> tuple[DataFrame, mixtures.Fits]:
    """(BIC and AIC for each number of components, with the lowest of each; the mixtures)."""
    fits = mixtures.fit(matrix, columns, ks, n_init)
    rows = [(k, f.log_likelihood, *mixtures.criteria(f.log_likelihood, k, fits.d, fits.n)) for k, f in fits.best.items()]
    by_bic, by_aic = (min(rows, key=lambda r: r[i])[0] if rows else None for i in (2, 3))
    found = matrix.sparkSession.createDataFrame(
        [(*r, r[0] == by_bic, r[0] == by_aic) for r in rows],
        "n_components int, log_likelihood double, bic double, aic double, optimal_bic boolean, optimal_aic boolean",
    )
    return found, fits


def gmm_select(
    matrix: DataFrame, columns: Sequence[str], ks: Sequence[int] = K_RANGE, n_init: int = STARTS
) -> DataFrame:
    """BIC and AIC for each number of components; the lowest BIC is chosen."""
    return gmm_selection(matrix, columns, ks, n_init)[0]


def gmm_labels(matrix: DataFrame, columns: Sequence[str], k: int = 5, n_init: int = STARTS) -> DataFrame:
    """The matrix with ``gmm_cluster`` and the probability of that component."""
    return mixtures.labelled(matrix, columns, mixtures.fit(matrix, columns, [k], n_init), k)


def gmm_fit(matrix: DataFrame, columns: Sequence[str], k: int = 5, n_init: int = STARTS) -> DataFrame:
    fits = mixtures.fit(matrix, columns, [k], n_init)
    schema = (
        "n_components int, covariance_type string, bic double, aic double, converged boolean, n_iterations int, "
        "avg_confidence double, min_confidence double, silhouette_score double"
    )
    if k not in fits.best:
        return matrix.sparkSession.createDataFrame([], schema)
    found = fits.best[k]
    labelled = cut_lineage(mixtures.labelled(matrix.select(*columns), columns, fits, k, "c").where(F.col("c").isNotNull()))
    confidence = labelled.agg(F.avg("confidence").alias("avg"), F.min("confidence").alias("min")).first()
    scores = _scores(label_quality(labelled, columns, ["c"]), columns)
    bic, aic = mixtures.criteria(found.log_likelihood, k, fits.d, fits.n)
    return matrix.sparkSession.createDataFrame(
        [(k, "full", bic, aic, found.converged, found.rounds, confidence["avg"], confidence["min"], scores["silhouette"])], schema
    )


# --- segment profiles -----------------------------------------------------------------------------------------------------

# Upper bounds of a segment's mean price relative to the overall mean.
SEGMENT_BOUNDS = ((0.5, "Budget"), (0.8, "Economy"), (1.2, "Mid-Range"), (1.8, "Premium"))
TOP_SEGMENT = "Enterprise"
NOISE_SEGMENT = "Noise/Outliers"


def cluster_profile_numeric(
    df: DataFrame, label: str = "cluster", columns: Sequence[str] = ("price_min", "price_max", "price_range")
) -> DataFrame:
    """Per cluster and price column: size, share and summary; noise is left out, but counts in the share."""
    if "price_range" in columns and "price_range" not in df.columns:
        df = df.withColumn("price_range", F.col("price_max") - F.col("price_min"))
    total = df.agg(F.count(F.lit(1))).scalar()
    kept = df.where(F.col(label) != -1)
    sizes = kept.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumn("percentage", F.col("size") * 100 / total)
    long = melt(kept, columns, [label])
    moments = long.groupBy(label, "column").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    medians = quantile_table(long, "value", {"median": 0.5}, [label, "column"]).drop("n")
    return moments.join(medians, [label, "column"]).join(sizes, label)


def cluster_profile_categorical(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Per cluster: its three most frequent categories and cities with their counts, and its verified share."""
    kept = df.where(F.col(label) != -1)
    top = union_batches(
        [topk_per_group(kept, label, c, 3).withColumn("attribute", F.lit(c)) for c in ("category", "city")]
    ).withColumnRenamed("count", "n")
    verified = kept.groupBy(label).agg((F.avg(F.col("supplier_verified").cast("int")) * 100).alias("verified_percentage"))
    return top.join(verified, label)


def segment_names(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Price tier of each cluster, by its mean price over the overall mean; several clusters may share a tier."""
    overall = df.agg(F.avg("price_min")).scalar()
    ratio = F.col("avg_price") / F.col("overall")
    tier = F.when(F.col(label) == -1, NOISE_SEGMENT)
    for bound, name in SEGMENT_BOUNDS:
        tier = tier.when(F.col("avg_price") < F.col("overall") * bound, name)
    tier = tier.when(ratio.isNotNull(), TOP_SEGMENT)
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("size"), F.avg("price_min").alias("avg_price"))
        .withColumn("overall", overall)
        .withColumn("segment_name", tier)
        .drop("overall")
    )


def segment_names_join(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Rows with the name of their segment."""
    return lookup_join(df, segment_names(df, label).select(label, "segment_name"), [label])
