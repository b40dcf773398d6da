import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.operators import blocks as B
from marketloom.operators import cluster as C
from marketloom.operators import features as E
from marketloom.operators import mixtures as M
from marketloom.operators import ward as W
from marketloom.schema import FEATURE_COLUMNS
from marketloom.sources.driver_tables import listings
from tests.conftest import SF_DIR


def frame(spark, x, labels=None):
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(i, *map(float, r), int(labels[i]) if labels is not None else 0) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + ", c long"), names


def blobs(seed=0, n=60):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.3, (n, 2)) for c in ((0, 0), (4, 0), (0, 5))])
    return x, np.repeat([0, 1, 2], n)


def test_scores_against_the_definitions(spark):
    x, labels = blobs()
    labels = labels.copy()
    labels[::7] = 1
    labels[5] = 3
    df, names = frame(spark, x, labels)
    got = C.cluster_metrics(df, names, "c").first()
    square = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    means = {c: x[labels == c].mean(axis=0) for c in set(labels)}
    scores = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            scores.append(0)
            continue
        a = square[i, own].sum() / (own.sum() - 1)
        b = min(square[i, labels == o].mean() for o in means if o != c)
        scores.append((b - a) / max(a, b))
    assert got["silhouette"] == pytest.approx(np.mean(scores))
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in means.items())
    between = sum((labels == c).sum() * ((m - x.mean(axis=0)) ** 2).sum() for c, m in means.items())
    k, n = len(means), len(x)
    assert got["calinski_harabasz"] == pytest.approx(between / (k - 1) / (within / (n - k)))
    spread = {c: np.sqrt(((x[labels == c] - m) ** 2).sum(axis=1)).mean() for c, m in means.items()}
    worst = [
        max((spread[a] + spread[b]) / np.linalg.norm(means[a] - means[b]) for b in means if b != a) for a in means
    ]
    assert got["davies_bouldin"] == pytest.approx(np.mean(worst))
    lone = C.cluster_metrics(df.withColumn("c", F.lit(0)), names, "c").first()
    assert lone["silhouette"] is None


def test_selection_finds_three_blobs(spark):
    df, names = frame(spark, blobs()[0])
    got = {r["k"]: r for r in C.kmeans_select_k(df, names, (2, 3, 4, 5)).collect()}
    assert got[3]["is_best_silhouette"] and got[3]["is_best_davies_bouldin"] and got[3]["is_chosen"]
    fit = C.kmeans_fit(df, names, 3, n_init=2).collect()
    assert sorted(r["size"] for r in fit) == [60, 60, 60]
    mixture = C.gmm_select(df, names, (2, 3, 4), n_init=4).where("optimal_bic").first()
    assert mixture["n_components"] == 3
    assert C.gmm_fit(df, names, 3, n_init=4).first()["avg_confidence"] > 0.99


def test_vote_ties_go_to_the_smallest_k():
    # Second differences -8, 1: the elbow index 0 points at the third k.
    assert C.choose_k((2, 3, 4, 5), [100.0, 90.0, 72.0, 55.0], [0.1, 0.9, 0.2, 0.1], [3, 2, 1.0, 2]) == (4, 4, 3, 4)
    assert C.choose_k((2, 3, 4, 5), [100.0, 90.0, 72.0, 55.0], [0.1, 0.9, 0.2, 0.1], [1.0, 2, 3, 2])[0] == 2


def brute_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        cost = lambda p, q: len(p) * len(q) / (len(p) + len(q)) * ((x[p].mean(axis=0) - x[q].mean(axis=0)) ** 2).sum()
        a, b = min(((i, j) for i in range(len(groups)) for j in range(i)), key=lambda t: cost(groups[t[0]], groups[t[1]]))
        groups[b] += groups.pop(a)
    return {frozenset(g) for g in groups}


def test_ward_is_exact_for_few_points(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(40, 2)), np.repeat(rng.normal(size=(2, 2)), 4, axis=0)])
    df, names = frame(spark, x)
    rows = C.hierarchical_labels(df, names, 4).toPandas()
    assert {frozenset(g["id"]) for _, g in rows.groupby("hier_cluster")} == brute_ward(x, 4)
    weights = rng.integers(1, 4, 30)
    few = rng.normal(size=(30, 3))
    label = W.groups(weights, few, 5)
    names_of = np.repeat(np.arange(30), weights)
    want = {frozenset(names_of[sorted(g)].tolist()) for g in brute_ward(np.repeat(few, weights, axis=0), 5)}
    assert {frozenset(np.flatnonzero(label == c).tolist()) for c in range(5)} == want


def test_ward_through_few_features(spark):
    x, labels = blobs(5, 100)
    df, names = frame(spark, x)
    rows = C.hierarchical_labels(df, names, 3, leaves=20).toPandas()
    assert {frozenset(g["id"]) for _, g in rows.groupby("hier_cluster")} == {
        frozenset(np.flatnonzero(labels == c).tolist()) for c in range(3)
    }


def agreement(a, b):
    """Adjusted Rand index of two labellings."""
    pairs = lambda n: n * (n - 1) / 2
    table = np.zeros((a.max() + 1, b.max() + 1))
    np.add.at(table, (a, b), 1)
    both, left, right = pairs(table).sum(), pairs(table.sum(1)).sum(), pairs(table.sum(0)).sum()
    expected = left * right / pairs(len(a))
    return (both - expected) / ((left + right) / 2 - expected)


def test_ward_of_5000_points_agrees_with_plain_ward(spark):
    rng = np.random.default_rng(12)
    groups = ((0, 1.0), (6, 1.5), (-6, 1.0), ((6, -6, 6, -6), 2.0), ((-6, 6, 0, 6), 0.5))
    x = np.concatenate([rng.normal(c, s, (1000, 4)) for c, s in groups])
    df, names = frame(spark, x)
    plain = W.groups(np.ones(len(x)), x, 5)
    rows = C.hierarchical_labels(df, names, 5).toPandas().sort_values("id")
    assert agreement(plain, rows["hier_cluster"].to_numpy()) > 0.99
    coarse = C.hierarchical_labels(df.repartition(7), names, 5, leaves=100).toPandas().sort_values("id")
    assert agreement(plain, coarse["hier_cluster"].to_numpy()) > 0.95


def test_draws_cover_all_rows_and_a_hot_point_takes_one(spark):
    """A point that a third of the rows share, and a far group of twenty rows: both are among the draws, the first one once."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.full((10_000, 3), 0.25), rng.normal(size=(20_000, 3)), rng.normal(40, 0.1, (20, 3))])
    df, names = frame(spark, x[rng.permutation(len(x))])
    points, weights = B.weighted_draws(B.pack(df.repartition(5), names), 3, 1)
    assert len(points) > 1000 and len(np.unique(points, axis=0)) == len(points)
    assert weights.sum() == len(x) and (points == 0.25).all(1).sum() == 1 and (points > 30).all(1).sum() > 0
    assert weights[(points == 0.25).all(1)] >= 10_000
    sizes = sorted(r["size"] for r in C.kmeans_fit(df, names, 2).collect())
    assert sizes[0] == 20


def test_mixture_of_fixed_groups_and_a_fit_in_collinear_features(spark):
    rng = np.random.default_rng(9)
    x, labels = blobs(9, 200)
    df, names = frame(spark, x, labels)
    got = M.from_labels(df, names, "c", ridge=0.0).first()
    density = np.zeros(len(x))
    for c in range(3):
        own = x[labels == c]
        gap, cov = x - own.mean(0), np.cov(own.T, bias=True)
        quad = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
        density += len(own) / len(x) * np.exp(-quad / 2) / (2 * np.pi * np.sqrt(np.linalg.det(cov)))
    assert got["log_likelihood"] == pytest.approx(np.log(density).sum())
    assert got["bic"] == pytest.approx(-2 * np.log(density).sum() + 17 * np.log(len(x)))
    # With a third, collinear feature the fit still has two dimensions and the same groups.
    wide = np.concatenate([x, x @ [[0.5], [2.0]]], 1)
    df, names = frame(spark, wide[rng.permutation(len(wide))])
    fit = M.fit(df, names, [3], 3)
    assert fit.d == 2 and fit.best[3].converged and fit.best[3].mixture.weights == pytest.approx([1 / 3] * 3, abs=0.01)
    rows = M.labelled(df.withColumn("f0", F.when(F.col("id") > 0, F.col("f0"))), names, fit, 3).collect()
    assert [r["gmm_cluster"] for r in rows if r["id"] == 0] == [None]
    assert all(r["confidence"] > 1 / 3 for r in rows if r["id"])
    none = df.where("id < 0")
    assert C.gmm_fit(none, names, 3).collect() == [] and C.gmm_select(none, names).collect() == []


def test_pca_against_eigenvalues(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3)) + 7
    df, names = frame(spark, x)
    got = C.pca(df, names).collect()
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert [r["explained_variance"] for r in got] == pytest.approx((values / values.sum()).tolist())
    scores, _ = C.pca_scores(df, names, 2)
    rows = scores.toPandas()
    assert rows["pca_1"].mean() == pytest.approx(0, abs=1e-9)
    assert rows["pca_1"].var() == pytest.approx(values[0])
    assert {r["components_for_95_pct"] for r in C.pca(df, names, 1).collect()} <= {None, 1}


def test_features_impute_and_scale(spark):
    df = listings(spark, SF_DIR)
    gapped = df.withColumn("price_max", F.when(F.col("id") % 3 != 0, F.col("price_max")))
    filled = E.impute_median(E.engineer_features(gapped))
    pdf = filled.select("id", *FEATURE_COLUMNS).toPandas()
    assert not pdf.isna().any().any()
    known = gapped.select("price_max").dropna().toPandas()["price_max"]
    assert pdf.loc[pdf["id"] % 3 == 0, "price_max"].unique() == pytest.approx([known.median()])
    for method, centre, width in (
        ("standard", lambda s: s.mean(), lambda s: s.std(ddof=0)),
        ("minmax", lambda s: s.min(), lambda s: s.max() - s.min()),
        ("robust", lambda s: s.median(), lambda s: s.quantile(0.75) - s.quantile(0.25)),
    ):
        got = E.scale_features(filled, FEATURE_COLUMNS, method).toPandas().set_index("id").sort_index()
        raw = pdf.set_index("id").sort_index().astype(float)
        for c in FEATURE_COLUMNS:
            want = (raw[c] - centre(raw[c])) / (width(raw[c]) or 1.0)
            assert np.allclose(got[c], want, atol=1e-9), (method, c)


def test_encodings_of_missing_names(spark):
    rows = [(1, 5.0, 6.0, "a", "x", True), (2, 9.0, 9.0, "b", None, None), (3, 1.0, 2.0, None, "x", False), (4, None, None, "b", "x", True)]
    df = spark.createDataFrame(
        rows, "id long, price_min double, price_max double, category string, city string, supplier_verified boolean"
    )
    got = {r["id"]: r for r in E.engineer_features(df).collect()}
    assert [got[i]["category_frequency"] for i in (1, 2, 3, 4)] == [1, 2, None, 2]
    assert [got[i]["category_price_rank"] for i in (1, 2, 3)] == [1.0, 2.0, None]
    assert [got[i]["city_frequency"] for i in (1, 2)] == [3, None]
    assert [got[i]["verified_int"] for i in (1, 2, 3)] == [1, 0, 0]


def test_segments(spark):
    rows = [(p, c) for c, p in ((0, 4.0), (1, 7.0), (2, 10.0), (3, 16.0), (4, 20.0), (-1, 3.0))]
    df = spark.createDataFrame(rows, "price_min double, cluster long")
    got = {r["cluster"]: r["segment_name"] for r in C.segment_names(df).collect()}
    assert got == {0: "Budget", 1: "Economy", 2: "Mid-Range", 3: "Premium", 4: "Enterprise", -1: "Noise/Outliers"}
    assert {r["segment_name"] for r in C.segment_names_join(df).collect()} == set(got.values())


def test_sizes_are_whole(spark):
    x, _ = blobs(8)
    df, names = frame(spark, x)
    assert sum(r["size"] for r in C.kmeans_fit(df.repartition(6), names, 4).collect()) == len(x)
    assert isinstance(C.label_quality(df, names, ["c"]), pd.DataFrame)


def test_large_tables_take_one_start_of_each_mixture_over_all_rows(spark, monkeypatch):
    x, _ = blobs(3, 2000)  # more rows than points of the weighted draw
    df, names = frame(spark, x)
    ks, widths, step = (2, 3, 4), [], M.step
    every = M.fit(df, names, ks)
    monkeypatch.setattr(B, "FINAL_ROWS", len(x))
    monkeypatch.setattr(M, "step", lambda blocks, width, change, centre, found: widths.append(len(found)) or step(blocks, width, change, centre, found))
    one = M.fit(df, names, ks)
    assert max(widths) == len(ks)
    assert one.n == len(x)
    for k in ks:
        assert one.best[k].log_likelihood == pytest.approx(every.best[k].log_likelihood, rel=2e-3)
    assert sorted(one.best[3].mixture.weights) == pytest.approx([1 / 3] * 3, abs=1e-3)


def test_large_tables_take_one_start_of_each_k_over_all_rows(spark, monkeypatch):
    x, _ = blobs(3, 2000)  # more rows than points of the weighted draw
    df, names = frame(spark, x)
    ks, widths, turn = (2, 3, 4), [], C._kmeans_round
    every = [r["inertia"] for r in C.kmeans_select_k(df, names, ks).collect()]
    monkeypatch.setattr(B, "FINAL_ROWS", len(x))
    monkeypatch.setattr(C, "_kmeans_round", lambda blocks, width, sets: widths.append(len(sets)) or turn(blocks, width, sets))
    one = C.kmeans_select_k(df, names, ks).collect()
    assert max(widths) == len(ks)
    assert [r["inertia"] for r in one] == pytest.approx(every, rel=2e-3)
    assert [r["k"] for r in one if r["is_chosen"]] == [3]


def test_lowest_merges_are_those_of_the_chains():
    rng = np.random.default_rng(3)
    size, x = rng.integers(1, 30, 500).astype(float), rng.normal(size=(500, 5))
    for keep in (499, 250, 7, 1):
        some = W.lowest_merges(size, x, 500 - keep)
        (group, height), (want, top) = W.cut(500, *some, keep), W.cut(500, *W.chain_merges(size, x), keep)
        assert (group == want).all() and height == pytest.approx(top) and len(some[0]) >= 500 - keep
    grid = np.stack(np.meshgrid(np.arange(12.0), np.arange(12.0)), -1).reshape(-1, 2)  # ties everywhere
    group, height = W.cut(144, *W.lowest_merges(np.ones(144), grid, 72), 72)
    assert group.max() == 71 and (np.bincount(group) == 2).all() and height == 0.5


def test_features_of_many_tasks_are_merged_a_few_at_a_time(spark, monkeypatch):
    """Tasks merge, not the driver: it meets at most ``FAN_IN`` tables."""
    x = np.random.default_rng(5).normal(size=(3000, 2))
    blocks = spark.createDataFrame([(x[i::30].tobytes(), np.ones(100).tobytes()) for i in range(30)], "x binary, w binary").repartition(30)
    met, real = [], W.condensed
    monkeypatch.setattr(W, "condensed", lambda state, leaves: met.append(len(state)) or real(state, leaves))
    found = W.features(blocks, 2, 50)
    assert len(found) == 50 and found[:, 0].sum() == 3000 and found[:, 2:].sum(0) == pytest.approx(x.sum(0))
    assert 0 < len(met) < W.FAN_IN
