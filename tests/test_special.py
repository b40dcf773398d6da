import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.functions import special as S


def column(spark, values, expression):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return [r["y"] for r in df.select(expression(F.col("x")).alias("y")).collect()]


def test_normal_functions(spark):
    xs = np.linspace(-8, 8, 161)
    assert column(spark, xs, S.erfc) == pytest.approx([math.erfc(x) for x in xs], rel=1e-12)
    ps = [1e-12, 1e-6, 0.01, 0.2, 0.5, 0.9, 0.999999]
    df = S.with_norm_ppf(spark.createDataFrame([(p,) for p in ps], "p double"), F.col("p"), "q")
    rows = df.withColumn("back", S.norm_cdf(F.col("q"))).collect()
    assert [r["q"] for r in rows] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-12)
    assert [r["back"] for r in rows] == pytest.approx(ps, rel=1e-10)
    # -x^2/2 - ln(x) - ln(2 pi)/2 to first order at 40 deviations.
    assert column(spark, [40.0], S.log_norm_sf)[0] == pytest.approx(-804.6084, abs=1e-3)


def test_tails_against_published_points():
    assert S.chi2_tail([11.0705, 3.8415, 18.307], [5, 1, 10]) == pytest.approx([0.05] * 3, abs=1e-5)
    assert S.f_tail([4.9646, 2.8661], [1, 4], [10, 20]) == pytest.approx([0.05] * 2, abs=1e-5)
    assert float(S.correlation_tail(0.4438, 20)) == pytest.approx(0.05, abs=1e-4)
    assert float(S.kolmogorov_tail(1.358 / math.sqrt(1e8), 1e8)) == pytest.approx(0.05, abs=1e-3)
    x = np.linspace(0.1, 60, 40)
    assert S.chi2_tail(x, 2) == pytest.approx(np.exp(-x / 2), rel=1e-12)
    assert S.beta_share(2, 1, x / 61) == pytest.approx((x / 61) ** 2, rel=1e-12)
    assert np.isnan(S.chi2_tail(np.nan, 2))
    assert S.chi2_upper_quantile(0.025, 2) == pytest.approx(-2 * math.log(0.025))


def test_large_shapes_converge():
    assert float(S.gamma_tail(1e6, 1e6)) == pytest.approx(0.49986702, abs=1e-6)


def test_sql_of_the_normal_distribution_equals_the_standard_library():
    from statistics import NormalDist

    import duckdb

    from checks import sqlmath

    con = duckdb.connect()
    for x in [i / 7 for i in range(-60, 61)]:
        upper, lower = con.execute(f"SELECT {sqlmath.sf(f'({x!r}::double)')}, {sqlmath.cdf(f'({x!r}::double)')}").fetchone()
        assert math.isclose(upper, math.erfc(x / math.sqrt(2)) / 2, rel_tol=1e-12)
        assert math.isclose(lower, math.erfc(-x / math.sqrt(2)) / 2, rel_tol=1e-12)
    for p in [1e-12, 1e-6, 0.01, 0.074, 0.076, 0.3, 0.5, 0.8, 0.99, 1 - 1e-9]:
        got = con.execute(f"SELECT {sqlmath.ppf(f'({p!r}::double)')}").fetchone()[0]
        assert math.isclose(got, NormalDist().inv_cdf(p), rel_tol=1e-9, abs_tol=1e-12)
