import numpy as np
import pytest

from marketloom.operators import density as D
from marketloom.operators import neighbours as N
from marketloom.operators.components import connected_components


def brute_dbscan(x, eps, min_samples):
    near = [np.flatnonzero(np.sqrt(((x - p) ** 2).sum(axis=1)) <= eps) for p in x]
    core = [len(n) >= min_samples for n in near]
    label, found = np.full(len(x), -1), 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        label[i], stack = found, [i]
        while stack:
            here = stack.pop()
            for j in near[here] if core[here] else []:
                if label[j] == -1:
                    label[j] = found
                    stack.append(j)
        found += 1
    return label


def points(d, seed):
    rng = np.random.default_rng(seed)
    blobs = [rng.normal(c, 0.25, (90, d)) for c in (0, 1.2, 3)]
    copies = np.repeat(rng.uniform(-2, 5, (3, d)), [7, 5, 120], axis=0)
    return rng.permutation(np.concatenate([*blobs, rng.uniform(-2, 5, (60, d)), copies]))


def frame(spark, x):
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names)), names


@pytest.mark.parametrize("d, eps, seed", [(1, 0.05, 4), (2, 0.35, 1), (2, 0.12, 3), (3, 0.5, 2)])
def test_dbscan_equals_the_definition(spark, d, eps, seed):
    x = points(d, seed)
    df, names = frame(spark, x)
    got = {r["id"]: r["dbscan_cluster"] for r in D.dbscan_labels(df, names, eps, 5).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, eps, 5).tolist()


def test_all_noise_and_one_cluster(spark):
    df, names = frame(spark, np.arange(12.0)[:, None] * 10)
    assert {r["dbscan_cluster"] for r in D.dbscan_labels(df, names, 1.0).collect()} == {-1}
    df, names = frame(spark, np.zeros((30, 2)))
    assert {r["dbscan_cluster"] for r in D.dbscan_labels(df, names, 1.0).collect()} == {0}
    assert {r["dbscan_cluster"] for r in D.dbscan_labels(df, names).collect()} == {0}
    assert {r["dbscan_cluster"] for r in D.dbscan_labels(df.limit(3), names).collect()} == {-1}


def kth(x, k):
    return np.sqrt(np.sort(((x[:, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, k - 1])


@pytest.mark.parametrize("block_rows", [40, 2048])
def test_k_distances_over_all_rows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(N, "BLOCK_ROWS", block_rows)
    x = np.concatenate([points(2, 9), np.tile(points(2, 9)[:1], (120, 1))])
    df, names = frame(spark, x)
    got = {r["id"]: r["distance"] for r in N.k_distances(df.repartition(5), names, 5).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(kth(x, 5).tolist(), abs=1e-9)
    assert N.k_distances(df.limit(3), names, 5).count() == 0


@pytest.mark.parametrize("values, eps, at", [([0.0, 0.0, 0.5, 0.6], 0.5, 1), ([0.1, 0.2, 0.9], 0.2, 1), ([0.3, 0.3], 0.3, 0), ([], 0.0, 0)])
def test_knee_skips_zero(spark, values, eps, at):
    df = spark.createDataFrame([(v,) for v in values], "distance double")
    assert N.knee(df) == (eps, at)


def test_knee_of_many_buckets(spark):
    x = np.sort(np.random.default_rng(3).exponential(size=40_000))
    at = int(np.argmax(np.diff(x)))
    df = spark.createDataFrame([(float(v),) for v in x], "distance double")
    assert N.knee(df) == (x[at], at)


def test_components_of_a_chain(spark):
    nodes = spark.range(40).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i + 1, i) for i in range(25)] + [(30, 39)], "a long, b long")
    got = {r["node"]: r["comp"] for r in connected_components(nodes, edges).collect()}
    assert got == {i: 0 if i <= 25 else 30 if i == 39 else i for i in range(40)}


def test_dbscan_in_twelve_features_equals_brute_force(spark):
    """2,000 rows of 12 collinear features in groups of uneven density, with equal rows, noise and border points."""
    rng = np.random.default_rng(14)
    base = np.concatenate(
        [rng.normal(0, 0.3, (700, 4)), rng.normal(3, 0.5, (600, 4)), rng.normal((0, 4, 0, 4), 0.2, (400, 4)), rng.uniform(-4, 7, (240, 4)), np.full((60, 4), 1.5)]
    )
    x = np.concatenate([base, base @ rng.normal(size=(4, 5)), np.abs(base[:, :3])], 1)[rng.permutation(2000)]
    names = [f"f{j}" for j in range(12)]
    df = spark.createDataFrame([(int(i), *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{n} double" for n in names))
    for eps in (0.8, 2.0):
        want = brute_dbscan(x, eps, 5)
        got = {r["id"]: r["dbscan_cluster"] for r in D.dbscan_labels(df.repartition(6), names, eps).collect()}
        assert [got[i] for i in range(2000)] == list(want)
        assert 2 < len(set(want)) and -1 in set(want)


def test_the_tree_is_fitted_on_more_rows_for_more_cells(spark, monkeypatch):
    monkeypatch.setattr(N, "SAMPLE", 64)
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    x = np.random.default_rng(3).normal(size=(800, 2))
    df, names = frame(spark, x)
    fitted = N._fitting_rows(df.withColumnRenamed("id", "key"), len(x)).toPandas()[names].to_numpy()
    assert 2 ** N._splits(fitted, 50)[2] > 64 // N.LEAST_SAMPLED
    gaps = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 1)[:, 4]
    got = {r["id"]: r["distance"] for r in N.k_distances(df, names).collect()}
    assert np.allclose([got[i] for i in range(len(x))], gaps)


def test_cells_are_linked_by_the_points_nearest_to_each_other(spark):
    rows = [(1, 0.0), (1, 0.9), (2, 1.1), (2, 2.0), (3, 5.0)]
    core = spark.createDataFrame(rows, "cell long, x0 double")
    boxes = spark.createDataFrame([(1, 0.0, 0.9), (2, 1.1, 2.0), (3, 5.0, 5.0)], "cell long, lo0 double, hi0 double")
    apart = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert [tuple(r) for r in D._closest_links(core, apart, boxes, 1, 0.25).collect()] == [(1, 2)]


@pytest.mark.parametrize("rows, d", [(3, 2), (30, 1), (3000, 3), (2000, 12)])
def test_squares_of_a_block_by_leaves(rows, d):
    rng = np.random.default_rng(rows)
    x = np.concatenate([rng.normal(size=(rows - 1, d)) * rng.choice([0.01, 1, 40], (rows - 1, 1)), np.full((1, d), 500.0)])
    x[rows // 2 : rows // 2 + rows // 5] = x[0]
    order, ends, best = N.block_squares(x, 5)
    square = best.max(1)
    assert sorted(order) == list(range(rows)) and ends[-1] == rows and np.diff(ends).max() <= max(N.LEAF_ROWS, 3)
    want = kth(x, 5)[order] if rows >= 5 else np.full(rows, np.inf)
    assert np.allclose(np.sqrt(square), want, rtol=1e-12, atol=0)


def test_k_distances_leave_out_gaps_and_merge_shared_keys(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 32)
    x = np.random.default_rng(8).normal(size=(300, 2))
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(900, None, 1.0), (901, float("nan"), 1.0), (0, *map(float, x[0]))]
    got = {r["id"]: r["distance"] for r in N.k_distances(spark.createDataFrame(rows, "id long, a double, b double"), ["a", "b"]).collect()}
    twice = np.concatenate([x, x[:1]])
    gaps = np.sort(np.sqrt(((twice[:, None] - twice[None]) ** 2).sum(2)), 1)
    want = {i: gaps[i, 4] for i in range(1, 300)} | {0: np.sort(np.concatenate([gaps[0, :5], gaps[300, :5]]))[4]}
    assert got == pytest.approx(want)


def test_a_wide_jump_is_found_without_ordering(spark, monkeypatch):
    monkeypatch.setattr(N, "_ordered_knee", lambda rows: pytest.fail("ordered"))
    x = np.sort(np.concatenate([np.random.default_rng(3).exponential(size=5000), [40.0]]))
    assert N.knee(spark.createDataFrame([(float(v),) for v in x], "distance double")) == (x[4999], 4999)


def test_clusters_of_equal_points_need_no_table_of_clusters(spark, monkeypatch):
    monkeypatch.setattr("marketloom.operators.cluster.LOOKUP_ROWS", 2)
    x = np.repeat(np.arange(6.0)[:, None] * [1, 2], [5, 6, 7, 5, 5, 1], axis=0)
    df, names = frame(spark, x)
    found = D.dbscan(df, names, 0.0).first()
    assert (found["n_clusters"], found["n_noise_points"], found["silhouette_score"]) == (5, 1, 1.0)
    assert D.dbscan(df, names, 0.0, 1).first()["silhouette_score"] == pytest.approx(28 / 29)
