import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.functions import special as S
from marketloom.operators import corr as C
from marketloom.operators import dist as D
from marketloom.operators import hypo as H
from marketloom.operators import profile as P
from marketloom.operators import ranks as R
from marketloom.session import cut_lineage


@pytest.fixture
def many_buckets(monkeypatch):
    monkeypatch.setattr(R.range_bounds, "__defaults__", (25,))


def grouped(seed=0, n=240):
    rng = np.random.default_rng(seed)
    values = rng.lognormal(1, 1, n).round(1)
    names = np.where(np.arange(n) % 3 == 0, "hot", rng.choice(["a", "b", "c"], n))
    return values.tolist(), names.tolist()


def test_mann_whitney_equals_pair_counting(prices, many_buckets):
    values, names = grouped()
    got = {(r["group_a"], r["group_b"]): r for r in H.mann_whitney_pairs(prices(values, names)).collect()}
    v, c = np.array(values), np.array(names)
    assert set(got) == set(combinations(sorted(set(names)), 2))
    for (a, b), row in got.items():
        x, y = v[c == a], v[c == b]
        u = (x[:, None] > y[None, :]).sum() + 0.5 * (x[:, None] == y[None, :]).sum()
        assert row["u_statistic"] == u
        pooled = pd.Series(np.concatenate([x, y])).value_counts().to_numpy().astype(float)
        n = len(x) + len(y)
        spread = math.sqrt(len(x) * len(y) / 12 * (n + 1 - (pooled**3 - pooled).sum() / (n * (n - 1))))
        z = (max(u, len(x) * len(y) - u) - len(x) * len(y) / 2 - 0.5) / spread
        assert row["p_value"] == pytest.approx(min(1, math.erfc(z / math.sqrt(2))), rel=1e-9)


def test_kruskal_with_ties(prices, many_buckets):
    values, names = grouped(1)
    ranks = pd.Series(values).rank()
    n, c = len(values), np.array(names)
    h = 12 / (n * (n + 1)) * sum(ranks[c == g].sum() ** 2 / (c == g).sum() for g in set(names)) - 3 * (n + 1)
    ties = pd.Series(values).value_counts().to_numpy().astype(float)
    h /= 1 - (ties**3 - ties).sum() / (n**3 - n)
    assert H.kruskal(prices(values, names)).first()["h_statistic"] == pytest.approx(h)


def test_lone_and_missing_groups_take_no_part(prices):
    df = prices([1.0, 2.0, 4.0, 9.0, 5.0, None], ["a", "a", "b", "b", "single", "a"])
    assert [r["group_a"] + r["group_b"] for r in H.mann_whitney_pairs(df).collect()] == ["ab"]
    # F of (1, 2) against (4, 9).
    assert H.anova(df).first()["f_statistic"] == pytest.approx(25 / 6.5)
    for test in (H.anova, H.kruskal, H.levene, H.bartlett, H.fligner, H.mann_whitney_pairs):
        assert test(prices([1.0, 2.0], ["a", "a"])).collect() == []


def test_yates_only_for_two_by_two(spark):
    def table(counts):
        rows = [(a, b) for (a, b), n in counts.items() for _ in range(n)]
        return spark.createDataFrame(rows, "category string, supplier_verified boolean")

    two = H.chi_square(table({("a", True): 10, ("a", False): 20, ("b", True): 30, ("b", False): 5})).first()
    e = np.outer([30, 35], [40, 25]) / 65
    o = np.array([[10, 20], [30, 5]])
    assert two["chi2_statistic"] == pytest.approx((((abs(o - e) - 0.5) ** 2) / e).sum())
    three = H.chi_square(table({("a", True): 10, ("b", False): 20, ("c", True): 3, ("c", False): 5})).first()
    o = np.array([[10, 0], [0, 20], [3, 5]])
    e = np.outer(o.sum(axis=1), o.sum(axis=0)) / o.sum()
    assert (three["chi2_statistic"], three["degrees_of_freedom"]) == (pytest.approx((((o - e) ** 2) / e).sum()), 2)
    assert H.chi_square(table({("a", True): 4, ("b", True): 2})).collect() == []


def test_correlations_skip_missing_pairs(spark, many_buckets):
    rng = np.random.default_rng(5)
    x = pd.DataFrame(rng.normal(size=(150, 3)).round(1), columns=list("xyz"))
    x.loc[rng.choice(150, 30, replace=False), "x"] = np.nan
    x["z"] += x["y"]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x.to_numpy())]
    df = spark.createDataFrame(rows, "id long, x double, y double, z double")
    pearson = x.corr()
    got = {(r["column_a"], r["column_b"]): r["r"] for r in C.pearson_matrix(df, "xyz").collect()}
    assert got == pytest.approx({(a, b): pearson.loc[a, b] for a in "xyz" for b in "xyz"})
    rho = {(r["column_a"], r["column_b"]): r["rho"] for r in C.spearman_matrix(df, "xyz").collect()}
    for a, b in combinations("xyz", 2):
        both = x[[a, b]].dropna().rank()
        assert rho[a, b] == rho[b, a] == pytest.approx(both[a].corr(both[b]))
    tau = {(r["column_a"], r["column_b"]): r["tau"] for r in C.kendall_matrix(df, "xyz").collect()}
    p, q = (x[["y", "z"]].to_numpy()[:, i] for i in (0, 1))
    s = sum(np.sign(p[i] - p[j]) * np.sign(q[i] - q[j]) for i, j in combinations(range(150), 2))
    free = lambda v: sum(v[i] != v[j] for i, j in combinations(range(150), 2))
    assert tau["y", "z"] == pytest.approx(s / math.sqrt(free(p) * free(q)))
    assert tau["x", "x"] == 1.0


@pytest.mark.parametrize("bucket_rows", [25, 100_000])
def test_kendall_over_many_buckets_hot_values_and_gaps(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(C, "KENDALL_BUCKET_ROWS", bucket_rows)
    rng = np.random.default_rng(11)
    n = 1500
    x = np.where(rng.random(n) < 0.35, 5.0, rng.integers(0, 400, n) / 3)
    y = np.where(rng.random(n) < 0.3, x, rng.integers(0, 90, n).astype(float))
    z = np.where(rng.random(n) < 0.1, np.nan, rng.normal(size=n))
    rows = [tuple(float(v) for v in r) for r in zip(x, y, z)]
    df = spark.createDataFrame(rows, "x double, y double, z double").withColumn("k", F.lit(1.0))
    got = {(r["column_a"], r["column_b"]): r["tau"] for r in C.kendall_pairs(df, "xyzk").collect()}
    for (a, p), (b, q) in combinations(zip("xyz", (x, y, z)), 2):
        both = ~np.isnan(p) & ~np.isnan(q)
        dp, dq = (np.sign(v[both][:, None] - v[both][None]) for v in (p, q))
        assert got[a, b] == pytest.approx((dp * dq).sum() / math.sqrt((dp**2).sum() * (dq**2).sum()), abs=1e-12)
    assert got["x", "k"] is None
    assert C.kendall_matrix(df.limit(0), "xy").where("tau is not null").count() == 0


def test_partial_correlation_equals_residuals(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    got = {(r["column_a"], r["column_b"]): r["partial_r"] for r in C.partial_correlation(df, "abcd").collect()}
    for i, j in combinations(range(4), 2):
        rest = np.column_stack([np.ones(80), np.delete(x, [i, j], axis=1)])
        left = [x[:, k] - rest @ np.linalg.lstsq(rest, x[:, k], rcond=None)[0] for k in (i, j)]
        assert got["abcd"[i], "abcd"[j]] == pytest.approx(np.corrcoef(*left)[0, 1])
    assert C.partial_correlation(df.limit(5), "abcd").collect() == []


def test_qq_and_normality_with_hot_value(prices, many_buckets, monkeypatch):
    monkeypatch.setattr(D, "POSITIONS_PER_CHUNK", 17)
    rng = np.random.default_rng(7)
    x = np.concatenate([np.full(100, 1.0), rng.normal(1, 2, 200)])
    df = prices(x.tolist())
    from statistics import NormalDist

    q = np.array([NormalDist().inv_cdf(p) for p in np.linspace(0.01, 0.99, 300)])
    got = D.qq_correlation(df, ["price_min"]).first()["qq_correlation"]
    assert got == pytest.approx(np.corrcoef(q, np.sort(x))[0, 1])
    z = (np.sort(x) - x.mean()) / x.std(ddof=1)
    cdf = np.array([NormalDist().cdf(v) for v in z])
    i = np.arange(1, 301)
    ks = max((cdf - (i - 1) / 300).max(), (i / 300 - cdf).max())
    assert D.normality_ks(df, ["price_min"]).first()["statistic"] == pytest.approx(ks)
    a2 = -300 - ((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))).sum() / 300
    assert D.normality_anderson(df, ["price_min"]).first()["statistic"] == pytest.approx(a2)


def test_shapiro_published_example(prices):
    # Shapiro and Wilk (1965), weights of eleven men.
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    row = D.normality_shapiro(prices(weights), ["price_min"]).first()
    assert row["statistic"] == pytest.approx(0.79, abs=0.005)
    assert row["p_value"] == pytest.approx(0.007, abs=0.001)
    assert D.normality_tests(prices([1.0] * 7), ["price_min"]).collect() == []


def test_fits_recover_parameters(prices):
    rng = np.random.default_rng(8)
    fits = lambda x: {r["distribution"]: r for r in D.fit_distributions(prices(x.tolist()), free=False).collect()}
    gamma = fits(rng.gamma(3.0, 2.0, 4000))
    assert gamma["gamma"]["parameters"] == pytest.approx({"a": 3.0, "scale": 2.0}, rel=0.1)
    assert gamma["gamma"]["ks_statistic"] < 0.03 and gamma["gamma"]["ks_p_value"] > 0.01
    weibull = fits(5 * rng.weibull(1.7, 4000))
    assert weibull["weibull_min"]["parameters"] == pytest.approx({"c": 1.7, "scale": 5.0}, rel=0.1)
    beta = fits(rng.beta(2.0, 5.0, 4000))
    assert beta["beta"]["ks_statistic"] < 0.05
    assert {r["is_best"] for r in gamma.values()} == {True, False}
    mixed = fits(np.array([-1.0, 0.5, 2.0, 3.0]))
    assert set(mixed) == {"norm", "expon", "beta"}
    assert D.fit_distributions(prices([2.0, 2.0])).collect() == []


def test_profile_of_hot_column(prices, many_buckets):
    rng = np.random.default_rng(9)
    x = pd.Series(rng.permutation(np.concatenate([np.full(100, 3.0), rng.lognormal(1, 1, 200)])))
    df = prices(x.tolist())
    row = P.central_tendency(df, ["price_min"]).first()
    cut = np.sort(x)[30:-30]
    assert (row["mode"], row["n"]) == (3.0, 300)
    assert row["trimmed_mean_10"] == pytest.approx(cut.mean())
    assert row["geometric_mean"] == pytest.approx(math.exp(np.log(x).mean()))
    assert row["harmonic_mean"] == pytest.approx(300 / (1 / x).sum())
    assert row["weighted_mean"] == pytest.approx(np.average(x, weights=np.arange(1, 301)))
    spread = P.dispersion(df, ["price_min"]).first()
    assert spread["mad"] == pytest.approx((x - x.median()).abs().median())
    assert spread["std_error"] == pytest.approx(x.sem())
    form = P.shape(df, ["price_min"]).first()
    z = (x - x.mean()) / x.std(ddof=0)
    assert (form["skewness"], form["kurtosis"]) == (pytest.approx((z**3).mean()), pytest.approx((z**4).mean() - 3))


def test_profile_of_nothing_and_of_a_constant(prices):
    empty = prices([None, None])
    for operator in (P.central_tendency, P.dispersion, P.shape, P.position):
        assert operator(empty, ["price_min"]).collect() == []
    row = P.dispersion(prices([0.0] * 5), ["price_min"]).first()
    assert (row["variance"], row["mad"], row["range_to_mean_ratio"]) == (0.0, 0.0, None)
    assert P.shape(prices([4.0] * 5), ["price_min"]).first()["bowley_skewness"] is None
    assert P.dataset_profile(prices([])).first()["missing_percentage"] is None
    twice = prices([1.0, 1.0]).select(F.lit(1).alias("id"), "price_min", F.lit(None).cast("string").alias("category"))
    row = P.dataset_profile(twice).first()
    assert (row["duplicate_rows"], row["missing_values"]) == (1, 2)


@pytest.mark.parametrize("family", ["lognorm", "gamma", "weibull_min", "beta"])
def test_free_location_beats_the_true_parameters(prices, family):
    rng = np.random.default_rng(17)
    n, loc = 3000, -40.0
    lgamma = math.lgamma
    if family == "lognorm":
        y = rng.lognormal(2.0, 0.4, n)
        true = (-((np.log(y) - 2.0) ** 2) / (2 * 0.16) - np.log(y) - math.log(0.4) - 0.5 * math.log(2 * math.pi)).sum()
    elif family == "gamma":
        y = rng.gamma(3.0, 5.0, n)
        true = (2 * np.log(y) - y / 5 - lgamma(3) - 3 * math.log(5)).sum()
    elif family == "weibull_min":
        y = 8 * rng.weibull(1.7, n)
        true = (math.log(1.7 / 8) + 0.7 * np.log(y / 8) - (y / 8) ** 1.7).sum()
    else:
        y = 30 * rng.beta(2.0, 3.5, n)
        true = (np.log(y / 30) + 2.5 * np.log(1 - y / 30) - lgamma(2) - lgamma(3.5) + lgamma(5.5) - math.log(30)).sum()
    df = prices(list(y + loc))
    got = {r["distribution"]: r for r in D.fit_distributions(df).collect()}
    own = got[family]
    assert true - 1e-6 <= own["log_likelihood"] < true + 12
    assert own["n_params"] == (4 if family == "beta" else 3) and own["is_best"] == (own["aic"] == min(r["aic"] for r in got.values()))
    assert own["parameters"]["loc"] == pytest.approx(loc, abs=1.5) and own["ks_statistic"] < 0.03
    assert [r["distribution"] for r in D.fit_distributions(df, names=("gamma", "norm"), free=False).collect()] == ["norm"]


def test_exact_laws_of_small_samples(prices):
    """U by enumeration of all arrangements, D by a published value and by simulation."""
    for a, b in ((1, 1), (2, 5), (4, 4), (5, 3), (8, 8)):
        counts = np.zeros(a * b + 1, int)
        for chosen in combinations(range(a + b), a):
            counts[sum(chosen) - a * (a - 1) // 2] += 1
        assert (S.mann_whitney_counts(a, b) == counts).all()
        for u in range(a * b + 1):
            want = min(1.0, 2 * counts[max(u, a * b - u) :].sum() / counts.sum())
            assert S.mann_whitney_exact(u, a, b) == pytest.approx(want)
    assert math.isnan(S.mann_whitney_exact(40, 9, 9)) and math.isnan(S.mann_whitney_exact(40, 8, 10_000))
    row = H.mann_whitney_pairs(prices([1, 2, 3, 4, 5, 6, 7], list("aababbb"))).first()
    assert row["u_statistic"] == 1 and row["p_value"] == pytest.approx(2 * 2 / 35)
    tied = H.mann_whitney_pairs(prices([1, 2, 2, 4, 5, 6, 7], list("aababbb"))).first()
    assert tied["p_value"] > 2 * 2 / 35
    assert S.kolmogorov_tail(0.274, 10) == pytest.approx(1 - 0.6284796154565043)
    assert S.kolmogorov_tail([0.04, 1.0], [10, 10]).tolist() == [1.0, 0.0]
    assert abs(S.kolmogorov_tail(0.03, 2000) - S.kolmogorov_tail(0.03, 2001)) < 2e-4
    rng = np.random.default_rng(8)
    x = np.sort(rng.random((20_000, 25)), axis=1)
    d = np.maximum(np.arange(1, 26) / 25 - x, x - np.arange(25) / 25).max(1)
    for q in (0.15, 0.2, 0.25):
        assert S.kolmogorov_tail(q, 25) == pytest.approx((d >= q).mean(), abs=0.012)


def test_correlations_with_a_column_of_one_value(spark):
    rows = [(1, 1.0, 3.0, None), (2, 2.0, 3.0, 1.0), (3, 4.0, 3.0, 2.5), (4, 5.0, 3.0, 2.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): (r["n"], r["r"]) for r in C.pearson_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == (4, None) and got["b", "b"] == (4, None) and got["a", "a"] == (4, pytest.approx(1.0))
    assert got["a", "c"] == (3, pytest.approx(np.corrcoef([2.0, 4.0, 5.0], [1.0, 2.5, 2.0])[0, 1]))
    assert C.spearman_matrix(df, ["a", "b"]).where("column_a = 'a' and column_b = 'b'").first()["rho"] is None
    assert D.qq_correlation(df.withColumn("b", F.lit(3.0)), ["b"]).collect() == []


def test_no_task_gets_all_positions_of_a_column(spark):
    df = spark.createDataFrame([(float(v % 37), float(v * v % 101)) for v in range(400)], "a double, b double")
    index = cut_lineage(R.column_ladder(df, ["a", "b"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for sizes the planner does not know
    try:
        tested = D.normality_shapiro(df, ["a", "b"], index)
        plan = tested._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [column" not in plan
        assert tested.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
