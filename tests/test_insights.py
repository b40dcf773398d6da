import numpy as np
import pytest

from marketloom.operators import cluster, density, features
from marketloom.operators import insights as I
from marketloom.schema import FEATURE_COLUMNS

SCHEMA = "id long, price_min double, price_max double, category string, city string, supplier_verified boolean"


@pytest.fixture
def listed(spark):
    rng = np.random.default_rng(5)
    low = np.concatenate([rng.normal(100, 5, 120), rng.normal(2000, 60, 60), rng.normal(9000, 200, 20)])
    rows = [
        (i, None if i == 7 else float(p), float(p * rng.uniform(1.1, 1.4)), "ABC"[min(i % 6, 2)], "xyz"[min(i % 7, 2)], bool(i % 2))
        for i, p in enumerate(low)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_the_insights_cover_every_clustering(spark, listed):
    assert "clustering" in I.PRODUCERS
    found = I.insights(listed, ("clustering",)).collect()
    by_rule = {r["rule"]: r for r in found}
    assert [r["rule"] for r in found][:6] == ["optimal_clusters", "kmeans", "dbscan", "hierarchical", "gmm", "pca"]
    assert {r["rule"] for r in found[6:]} == {"segment"}

    names, matrix = list(FEATURE_COLUMNS), features.feature_matrix(listed)
    k = by_rule["optimal_clusters"]["value"]
    assert by_rule["kmeans"]["text"].startswith(f"K-Means clustering: {k:.0f} clusters")
    segments = [r for r in found if r["rule"] == "segment"]
    assert len(segments) == k and sum(r["value"] for r in segments) == 200
    assert sum(float(r["text"].split("(")[1][:-2]) for r in segments) == pytest.approx(100, abs=1)

    dense = density.dbscan(matrix, names).first()
    want = f"DBSCAN: {dense['n_clusters']} clusters, {dense['n_noise_points']} noise points ({dense['noise_percentage']:.1f}%)"
    assert by_rule["dbscan"]["text"] == want
    ward = cluster.hierarchical_cluster(matrix, names).first()
    assert by_rule["hierarchical"]["text"] == f"Hierarchical clustering: 5 clusters, silhouette {ward['silhouette']:.3f}"
    assert 0 < by_rule["gmm"]["value"] <= 1
    whole = np.cumsum(np.linalg.eigvalsh(np.corrcoef(np.array(matrix.select(*names).collect()).T))[::-1]) / 12
    enough = int(np.flatnonzero(whole >= 0.95)[0]) + 1
    assert by_rule["pca"]["text"] == f"PCA: {enough} components explain 95% variance, 2 explain {whole[1] * 100:.1f}%"


def test_no_listing_gives_no_clustering(spark):
    assert I.insights(spark.createDataFrame([], SCHEMA), ("clustering",)).count() == 0
