import numpy as np
import pytest

from marketloom.operators import outliers as O


def brute_lof(x, k):
    gap = np.abs(x[:, None] - x[None, :])
    np.fill_diagonal(gap, np.inf)
    near = np.argsort(gap, axis=1, kind="stable")[:, :k]
    distance = np.take_along_axis(gap, near, 1)
    reach = distance[:, -1]
    density = 1 / (np.maximum(reach[near], distance).mean(axis=1) + 1e-10)
    return density[near].mean(axis=1) / density


def test_lof_needs_k_values(prices):
    values = [float(i) for i in range(20)]
    assert O.outliers_lof(prices(values)).count() == 1
    assert O.outliers_lof(prices(values[:19])).count() == 0


def test_lof_with_hot_values_across_blocks(prices, monkeypatch):
    monkeypatch.setattr(O, "LOF_BLOCK", 150)
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, 500), np.repeat([0.5, 1.25], [300, 60]), rng.uniform(-20, 20, 60)])
    got = {r["value"]: (r["lof"], r["ties"]) for r in O.lof_factors(prices(x.tolist())).collect()}
    assert [got[v][0] for v in x] == pytest.approx(brute_lof(x, 20).tolist(), rel=1e-9)
    assert got[0.5][1] == 300


def test_rules_on_known_values(prices):
    values = [10.0, 11, 12, 13, 14, 15, 16, 100, None]
    row = O.outliers_iqr(prices(values)).first()
    assert (row["q1"], row["q3"], row["outlier_count"], row["extreme_outlier_count"]) == (11.75, 15.25, 1, 1)
    mad = O.outliers_mad(prices(values)).first()
    assert (mad["median"], mad["mad"], mad["outlier_count"]) == (13.5, 2.0, 1)
    flags = [r for r in O.anomaly_flags(prices(values)).collect() if r["is_iqr_outlier"]]
    assert [r["id"] for r in flags] == [7]


def test_constant_column(prices):
    df = prices([5.0] * 30)
    assert O.outliers_iqr(df).first()["outlier_count"] == 0
    assert O.outliers_zscore(df).first()["outliers_2sigma"] == 0
    assert O.outliers_mad(df).collect() == []
    assert {r["outlier_count"] for r in O.outliers_iforest(df).collect()} == {0}
    assert O.outliers_lof(df).first()["outlier_count"] == 0


def test_empty_and_tiny(prices):
    for values in ([], [None, None]):
        df = prices(values)
        assert O.outliers_iqr(df).collect() == []
        assert O.outliers_zscore(df).collect() == []
        assert O.outliers_mad(df).collect() == []
        assert O.outliers_lof(df).collect() == []
    assert O.outliers_lof(prices([1.0, 2.0])).collect() == []


def test_isolation_forest_flags_the_far_values(prices):
    rng = np.random.default_rng(1)
    values = rng.normal(100, 5, 960).tolist() + rng.uniform(400, 900, 40).tolist()
    scores = {r["id"]: r["score"] for r in O.isolation_scores(prices(values)).collect()}
    assert min(scores[i] for i in range(960, 1000)) > np.median([scores[i] for i in range(960)])
    counts = {r["contamination"]: r["outlier_count"] for r in O.outliers_iforest(prices(values)).collect()}
    assert all(0.8 * c * 1000 <= n <= c * 1000 for c, n in counts.items())


def test_forest_step_function_equals_the_trees():
    rng = np.random.default_rng(2)
    import pandas as pd

    rows = pd.DataFrame({"tree": 3, "_order": range(64), "v": rng.normal(size=64)})
    nodes = O._grow_tree(["v"], rows)
    tree = {c: nodes[c].to_numpy() for c in ("feature", "cut", "left", "right", "length")}
    cuts = np.unique(tree["cut"][tree["feature"] >= 0])
    steps = O._mean_length([tree], np.append(cuts, np.inf)[:, None])
    probe = np.concatenate([rng.normal(size=200), cuts])
    assert O._mean_length([tree], probe[:, None]).tolist() == steps[np.searchsorted(cuts, probe, side="left")].tolist()


def test_robust_distance_ignores_a_far_group(spark):
    rng = np.random.default_rng(3)
    near, far = rng.normal(0, 1, (450, 2)), rng.normal(30, 1, (50, 2))
    x = np.concatenate([near, far])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, price_min double, price_max double")
    got = {r["id"]: r["distance"] for r in O.robust_distances(df, ["price_min", "price_max"]).collect()}
    assert min(got[i] for i in range(450, 500)) > max(got[i] for i in range(450))
    assert O.outliers_elliptic(df).first()["outlier_count"] == 50
    flat = df.selectExpr("id", "price_min", "price_min * 2 as price_max")
    assert O.outliers_elliptic(flat).collect() == []
