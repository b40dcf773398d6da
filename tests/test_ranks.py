import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketloom.operators import dist as D
from marketloom.operators import groups as G
from marketloom.operators import profile as P
from marketloom.operators import ranks as R


@pytest.fixture
def many_buckets(monkeypatch):
    monkeypatch.setattr(R.range_bounds, "__defaults__", (40,))


def skewed(n=900, seed=0):
    rng = np.random.default_rng(seed)
    values = np.concatenate([np.full(n // 3, 7.0), rng.lognormal(2, 1.5, n - n // 3)])
    return rng.permutation(values).tolist()


def test_average_ranks_with_a_hot_value(prices, many_buckets):
    values = skewed()
    got = R.value_ladder(prices(values), "price_min").select("value", "ties", R.average_rank().alias("r")).collect()
    want = dict(zip(values, pd.Series(values).rank()))
    assert {r["value"]: r["r"] for r in got} == want
    assert sum(r["ties"] * r["r"] for r in got) == len(values) * (len(values) + 1) / 2


@pytest.mark.parametrize("partitions", [1, 7])
def test_quantiles_by_group(prices, many_buckets, partitions):
    values, probs = skewed(), [0.01, 0.25, 0.5, 0.75, 0.9]
    categories = ["hot" if i % 3 else "cold" for i in range(len(values))]
    df = prices(values, categories).repartition(partitions)
    got = {(r["category"], r["p"]): r["quantile"] for r in R.exact_quantiles(df, "price_min", probs, ["category"]).collect()}
    for name in ("hot", "cold"):
        own = [v for v, c in zip(values, categories) if c == name]
        for p in probs:
            assert got[name, p] == pytest.approx(np.quantile(own, p), rel=1e-12)


def test_weighted_quantile_counts_copies(spark, many_buckets):
    values, copies = [1.0, 2.0, 5.0], [3, 1, 4]
    df = spark.createDataFrame(list(zip(values, copies)), "v double, w long")
    got = R.exact_quantiles(df, "v", [0.3, 0.5], weight="w").collect()
    assert {r["p"]: r["quantile"] for r in got} == {p: np.quantile(np.repeat(values, copies), p) for p in (0.3, 0.5)}


def test_positions_follow_the_key(prices, many_buckets):
    df = prices(skewed()).orderBy(F.xxhash64("id"))
    got = {r["id"]: r["position"] for r in R.row_positions(df, "id").collect()}
    assert got == {i: i + 1 for i in range(len(got))}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50, width=16)), min_size=0, max_size=40))
def test_quantiles_of_any_list(prices, values):
    got = R.exact_quantiles(prices(values), "price_min", [0.0, 0.37, 1.0]).collect()
    present = [v for v in values if v is not None]
    assert len(got) == (3 if present else 0)
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile(present, r["p"]), abs=1e-9)


def test_percentile_within_category(prices, many_buckets):
    values = skewed(300)
    categories = ["a" if i % 4 else "b" for i in range(300)]
    got = {r["id"]: r["price_percentile"] for r in G.price_percentile(prices(values, categories)).collect()}
    want = pd.DataFrame({"v": values, "c": categories}).groupby("c")["v"].rank(pct=True)
    assert got == pytest.approx(want.to_dict())


def test_sketches_merge_over_partitions(prices, monkeypatch):
    monkeypatch.setattr(R, "SKETCH_GRID", 8)
    values = skewed(600)
    bounds = R.range_bounds(prices(values).repartition(50), "price_min", 30)
    assert bounds == sorted(set(bounds)) and 5 <= len(bounds) <= 20


def test_a_stored_index_gives_the_results_of_the_rows(spark, tmp_path, many_buckets):
    rng = np.random.default_rng(21)
    a = rng.lognormal(1, 1, 400).round(1)
    rows = [(i, float(x), None if i % 7 == 0 else float(-x * (i % 5)), 3.0) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    columns = ["a", "b", "c"]
    R.write_index(df, columns, str(tmp_path / "index"))
    index = R.read_index(spark, str(tmp_path / "index"))
    assert index.groupBy("column").count().count() == 3
    for build in (P.central_tendency, P.dispersion, P.shape, P.position, D.normality_tests, D.normality_verdict, D.qq_correlation):
        plain, stored = build(df, columns), build(df, columns, index=index)
        assert plain.columns == stored.columns, build
        key = [c for c in ("column", "test") if c in plain.columns]
        for x, y in zip(plain.orderBy(*key).collect(), stored.orderBy(*key).collect()):
            assert [pytest.approx(v) if isinstance(v, float) else v for v in x] == list(y), build


def test_tasks_of_a_ladder_grow_with_its_rows_not_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(R, "ROWS_PER_TASK", 100)
    values = [None, float("nan"), *([0.0, -0.0] * 300), *[float(v % 97) - 40 for v in range(800)]]
    rows = [(("a", "b")[i % 3 == 0], v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "column string, value double")
    ladder = R.value_ladder(df, "value", ["column"])
    plan = ladder._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [column" in plan and plan.count(", 14\n") == 1  # 1,400 usable rows, shuffled once
    got = sorted((r["column"], r["value"], r["ties"], r["below"], r["total"]) for r in ladder.collect())
    expected = []
    for name in "ab":
        own = [v + 0.0 for c, v in rows if c == name and v is not None and v == v]
        expected += [(name, v, own.count(v), sum(o < v for o in own), len(own)) for v in sorted(set(own))]
    assert got == expected
