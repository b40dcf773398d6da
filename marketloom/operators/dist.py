"""Normality tests, distribution fits and the quantile-quantile correlation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import special as S
from marketloom.functions.special import beta_share, gamma_tail
from marketloom.operators.blocks import pack, total
from marketloom.operators.groups import union_batches
from marketloom.operators.lookup import lookup_join, settled
from marketloom.operators.ranks import column_ladder, melt, usable, value_ladder
from marketloom.session import cut_lineage

ALPHA = 0.05
MIN_ROWS = 8
SHAPIRO_MAX_ROWS = 5000
POSITIONS_PER_CHUNK = 10_000

# Anderson-Darling critical points for the normal case, by significance level in percent (Stephens 1974).
ANDERSON_LEVELS = (15.0, 10.0, 5.0, 2.5, 1.0)
ANDERSON_POINTS = (0.576, 0.656, 0.787, 0.918, 1.092)


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, mean, sd, skew, kurt) of columns long enough to be tested; one row per named column."""
    return settled(
        melt(df, columns)
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("sd"),
            F.skewness("value").alias("skew"),
            F.kurtosis("value").alias("kurt"),
        )
        .where(F.col("n") >= MIN_ROWS)
    )


def _standard_ladder(df: DataFrame, columns: Sequence[str], index: DataFrame | None) -> DataFrame:
    """Ladder rows per column with their standardised value ``z``; constant columns drop out."""
    ladder = column_ladder(df, columns, index)
    joined = lookup_join(ladder, _moments(df, columns).where("sd > 0"), ["column"], "inner")
    return joined.withColumn("z", (F.col("value") - F.col("mean")) / F.col("sd"))


def _tested(stat: DataFrame, test: str, p: Column) -> DataFrame:
    return stat.withColumn("p_value", p).select(
        "column", F.lit(test).alias("test"), "statistic", "p_value", (F.col("p_value") > ALPHA).alias("is_normal")
    )


def normality_dagostino(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Omnibus test: squared skewness and kurtosis scores."""
    n, g1, b2 = F.col("n"), F.col("skew"), F.col("kurt") + 3
    spread = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    ratio = spread / F.sqrt(2 / (w2 - 1))
    z_skew = F.ln(ratio + F.sqrt(ratio * ratio + 1)) / F.sqrt(0.5 * F.ln(w2))
    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - expected) / F.sqrt(variance)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    base = 1 + x * F.sqrt(2 / (a - 4))
    cube = F.signum(base) * F.pow((1 - 2 / a) / F.abs(base), F.lit(1 / 3))
    z_kurt = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    stat = _moments(df, columns).where("sd > 0").withColumn("statistic", z_skew * z_skew + z_kurt * z_kurt)
    return _tested(stat, "dagostino_pearson", F.exp(-F.col("statistic") / 2))


def normality_jarque_bera(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    skew, kurt = F.col("skew"), F.col("kurt")
    stat = _moments(df, columns).where("sd > 0")
    stat = stat.withColumn("statistic", F.col("n") / 6 * (skew * skew + kurt * kurt / 4))
    return _tested(stat, "jarque_bera", F.exp(-F.col("statistic") / 2))


def normality_ks(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """Largest gap between the empirical distribution and the fitted normal."""
    below, upto = F.col("below") / F.col("n"), (F.col("below") + F.col("ties")) / F.col("n")
    cdf = S.norm_cdf(F.col("z"))
    stat = (
        _standard_ladder(df, columns, index)
        .groupBy("column")
        .agg(F.max(F.greatest(cdf - below, upto - cdf)).alias("statistic"), F.max("n").alias("n"))
    )
    return _tested(stat, "kolmogorov_smirnov", S.kolmogorov_p("statistic", "n"))


def normality_anderson(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """A squared with its critical values; there is no p-value, the 5 % point decides.

    A value with ties covers several positions, whose odd weights telescope into differences of squares.
    """
    first, last = F.col("below").cast("double"), (F.col("below") + F.col("ties")).cast("double")
    n = F.col("n")
    lower = (last * last - first * first) * S.log_norm_sf(-F.col("z"))
    upper = ((n - first) * (n - first) - (n - last) * (n - last)) * S.log_norm_sf(F.col("z"))
    stat = (
        _standard_ladder(df, columns, index)
        .groupBy("column")
        .agg(F.sum(lower + upper).alias("weighted"), F.max("n").alias("n"))
        .withColumn("statistic", -n - F.col("weighted") / n)
    )
    shrink = 1 + 4 / n - 25 / (n * n)
    points = [F.round(F.lit(p) / shrink, 3) for p in ANDERSON_POINTS]
    names = [f"critical_{level:g}".replace(".", "_") for level in ANDERSON_LEVELS]
    return stat.select(
        "column",
        F.lit("anderson_darling").alias("test"),
        "statistic",
        *[point.alias(name) for point, name in zip(points, names)],
        (F.col("statistic") < points[2]).alias("is_normal"),
    )


def positions(ladder: DataFrame) -> DataFrame:
    """Ladder rows repeated once per row they stand for, with its ``place`` (1..total).

    A value shared by very many rows is first cut into chunks that are spread over the cluster.
    """
    chunks = F.sequence(F.col("below"), F.col("below") + F.col("ties") - 1, F.lit(POSITIONS_PER_CHUNK).cast("long"))
    last = F.least(F.col("chunk") + POSITIONS_PER_CHUNK, F.col("below") + F.col("ties"))
    many = F.col("ties") > POSITIONS_PER_CHUNK
    ladder = cut_lineage(ladder)
    # The partition count is not fixed, so AQE may size the spread chunks itself.
    hot = ladder.where(many).withColumn("chunk", F.explode(chunks)).repartition("chunk")
    cold = ladder.where(~many).withColumn("chunk", F.col("below"))
    spread = hot.unionByName(cold)
    return spread.withColumn("place", F.explode(F.sequence(F.col("chunk") + 1, last))).drop("chunk")


def qq_correlation(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """Correlation of the sorted values with normal quantiles spread evenly over 0.01 .. 0.99."""
    ladder = column_ladder(df, columns, index).where(F.col("total") >= 10)
    p = F.lit(0.01) + F.lit(0.98) * (F.col("place") - 1) / (F.col("total") - 1)
    return (
        S.with_norm_ppf(positions(ladder), p, "q")
        .groupBy("column")
        # null for a column of one value, which has no correlation
        .agg(F.try_divide(F.covar_pop("q", "value"), F.stddev_pop("q") * F.stddev_pop("value")).alias("qq_correlation"))
        .withColumn("is_approximately_normal", F.col("qq_correlation") > 0.95)
    )


def _royston_p(w: float, n: int) -> float | None:
    """The p-value of W, which holds up to 5000 values (Royston 1995)."""
    if n > SHAPIRO_MAX_ROWS:
        return None
    if n >= 12:
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], math.log(n))
        sigma = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], math.log(n)))
        score = math.log(1 - w) if w < 1 else -math.inf
    else:
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sigma = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
        score = -math.log(-2.273 + 0.459 * n - math.log(1 - w)) if w < 1 else -math.inf
    return 0.5 * math.erfc((score - mu) / sigma / math.sqrt(2))


def _shapiro_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shapiro-Wilk W from the sums over a column's positions and its two outermost values and scores at each end."""
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            n, total = r.n, r.mm
            if r.x_first == r.x_last:
                rows.append((r.column, 1.0, 1.0))
                continue
            u = 1 / math.sqrt(n)
            # Royston's polynomials, highest power first.
            end = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0], u) + r.m_last / math.sqrt(total)
            near = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0], u) + r.m_near / math.sqrt(total)
            scale = math.sqrt((total - 2 * r.m_last**2 - 2 * r.m_near**2) / (1 - 2 * end**2 - 2 * near**2))
            inner = r.mx - r.m_last * (r.x_last - r.x_first) - r.m_near * (r.x_near - r.x_second)
            sum_ax = inner / scale + end * (r.x_last - r.x_first) + near * (r.x_near - r.x_second)
            w = min(1.0, sum_ax**2 / r.spread)
            rows.append((r.column, w, _royston_p(w, n)))
        yield pd.DataFrame(rows, columns=["column", "statistic", "p_value"])


def normality_shapiro(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """W for any number of values, from one aggregation over their positions; beyond 5000 values its p-value, and so the verdict, is null."""
    ladder = column_ladder(df, columns, index).where(F.col("total") >= MIN_ROWS)
    scored = S.with_norm_ppf(positions(ladder), (F.col("place") - 0.375) / (F.col("total") + 0.25), "q")
    at = lambda c, place: F.max(F.when(F.col("place") == place, F.col(c)))
    # One row per named column; a shuffle by column would bring all positions of a column into one task.
    means = ladder.groupBy("column").agg((F.sum(F.col("value") * F.col("ties")) / F.sum("ties")).alias("mean"))
    centred = scored.join(F.broadcast(means), "column").withColumn("x", F.col("value") - F.col("mean"))
    sums = centred.groupBy("column").agg(
        F.max("total").alias("n"),
        F.sum(F.col("x") * F.col("x")).alias("spread"),
        F.sum(F.col("q") * F.col("q")).alias("mm"),
        F.sum(F.col("q") * F.col("x")).alias("mx"),
        at("x", F.lit(1)).alias("x_first"),
        at("x", F.lit(2)).alias("x_second"),
        at("x", F.col("total") - 1).alias("x_near"),
        at("x", F.col("total")).alias("x_last"),
        at("q", F.col("total") - 1).alias("m_near"),
        at("q", F.col("total")).alias("m_last"),
    )
    stat = sums.mapInPandas(_shapiro_rows, "column string, statistic double, p_value double")
    return _tested(stat, "shapiro_wilk", F.col("p_value"))


def normality_tests(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """All tests in one table; Anderson-Darling has no p-value."""
    if index is None and len(columns):  # five tests on one ladder
        index = cut_lineage(column_ladder(df, columns))
    anderson = normality_anderson(df, columns, index).select(
        "column", "test", "statistic", F.lit(None).cast("double").alias("p_value"), "is_normal"
    )
    return union_batches(
        [
            normality_shapiro(df, columns, index),
            normality_dagostino(df, columns),
            normality_jarque_bera(df, columns),
            normality_ks(df, columns, index),
            anderson,
        ]
    )


def normality_verdict(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """Likely normal when at least half of the tests run, rounded down, do not reject."""
    return (
        normality_tests(df, columns, index)
        .groupBy("column")
        .agg(F.count_if("is_normal").alias("tests_passed"), F.count("is_normal").alias("total_tests"))
        .withColumn("is_likely_normal", F.col("tests_passed") >= F.floor(F.col("total_tests") / 2))
    )


# --- distribution fits -------------------------------------------------------------------------------------------------


def _digamma(x: float) -> float:
    shift = 0.0
    while x < 10:
        shift -= 1 / x
        x += 1
    y = 1 / (x * x)
    return shift + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def _trigamma(x: float) -> float:
    shift = 0.0
    while x < 10:
        shift += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return shift + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def _fit_gamma(mean: float, mean_log: float) -> tuple[float, float]:
    """Shape and scale from the mean and the mean logarithm."""
    gap = math.log(mean) - mean_log
    if gap <= 0:
        raise ValueError("no spread")
    shape = (3 - gap + math.sqrt((gap - 3) ** 2 + 24 * gap)) / (12 * gap)
    for _ in range(100):
        step = (math.log(shape) - _digamma(shape) - gap) / (1 / shape - _trigamma(shape))
        shape = shape - step if shape > step else shape / 2
        if abs(step) < 1e-13 * shape:
            break
    return shape, mean / shape


def _fit_beta(log_x: float, log_rest: float, mean: float, variance: float) -> tuple[float, float]:
    """Both shapes from the mean logarithms of x and 1 - x, started at the moment estimate."""
    common = mean * (1 - mean) / variance - 1
    a, b = max(mean * common, 1e-3), max((1 - mean) * common, 1e-3)
    for _ in range(200):
        both = _digamma(a + b)
        g1, g2 = _digamma(a) - both - log_x, _digamma(b) - both - log_rest
        t = _trigamma(a + b)
        h11, h22 = _trigamma(a) - t, _trigamma(b) - t
        det = h11 * h22 - t * t
        da, db = (h22 * g1 + t * g2) / det, (t * g1 + h11 * g2) / det
        a, b = (a - da if a > da else a / 2), (b - db if b > db else b / 2)
        if abs(da) + abs(db) < 1e-12 * (a + b):
            break
    return a, b


def _weibull_shape(rows: DataFrame, mean_log: float, max_rounds: int = 40) -> float:
    """Newton rounds on the shape; each round is one aggregate over the column.

    Values are divided by their geometric mean, so the powers stay in range.
    """
    log_x = F.ln("x") - mean_log
    shape = 1.0
    for _ in range(max_rounds):
        power = F.exp(log_x * shape)
        s = rows.agg(
            F.sum(power).alias("s0"), F.sum(power * log_x).alias("s1"), F.sum(power * log_x * log_x).alias("s2")
        ).first()
        ratio = s["s1"] / s["s0"]
        value = ratio - 1 / shape
        slope = s["s2"] / s["s0"] - ratio**2 + 1 / shape**2
        step = value / slope
        shape = shape - step if shape > step else shape / 2
        if abs(step) < 1e-12 * shape:
            break
    return shape


# The gap between the location and the smallest value (for beta also between the largest value and the end), in standard deviations.
GAP_RANGE = (1e-3, 1e2)
SHAPE_RANGE = (0.05, 50.0)
GRID = 41
PLANE = 21  # points a side, where two parameters are sought together
ZOOMS = 7


def _profiles(gaps: dict[str, tuple[np.ndarray, ...]], mean: float, low: float, high: float, sd: float, blocks: DataFrame) -> dict[str, np.ndarray]:
    """Mean log-likelihood of every family at every candidate point, the other parameters at their best, from one pass over all rows.

    ``gaps`` holds the candidates' gaps, for ``weibull_min`` also shapes and for ``beta`` also the gaps at the upper end.
    """
    lower = np.concatenate([g[0] for g in gaps.values()])
    upper = gaps["beta"][1] if "beta" in gaps else np.zeros(0)
    shapes = gaps["weibull_min"][1] if "weibull_min" in gaps else np.zeros(0)
    from_weibull = gaps["weibull_min"][0] if "weibull_min" in gaps else np.zeros(0)
    centre = np.log(sd + from_weibull)

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        y = np.log(x - low + lower)
        powers = [w @ np.exp((np.log(x - low + from_weibull) - centre) * c) for c in shapes]
        parts = [[w.sum()], w @ y, w @ (y * y), w @ np.log(high - x + upper), *powers]
        return np.concatenate(parts)[None, :]

    with np.errstate(over="ignore"):
        sums = total(blocks, 1, kernel)[0]
    n, sums = sums[0], sums[1:] / sums[0]
    logs, squares, tops = np.split(sums, np.cumsum([len(lower), len(lower), len(upper)]))[:3]
    powers = sums[2 * len(lower) + len(upper) :].reshape(len(shapes), -1)
    out, at = {}, 0
    for name, (g, *_) in gaps.items():
        ml, sl = logs[at : at + len(g)], squares[at : at + len(g)]
        at += len(g)
        if name == "lognorm":
            spread = np.maximum(sl - ml * ml, 1e-300)
            out[name] = -(0.5 * np.log(spread) + ml + 0.5 * math.log(2 * math.pi) + 0.5)
        elif name == "gamma":
            shape = np.array([_fit_gamma(mean - low + a, b)[0] for a, b in zip(g, ml)])
            norm = np.array([math.lgamma(a) for a in shape])
            out[name] = (shape - 1) * ml - shape - norm - shape * np.log((mean - low + g) / shape)
        elif name == "weibull_min":
            with np.errstate(divide="ignore", invalid="ignore"):
                ll = np.log(shapes)[:, None] - np.log(powers) - shapes[:, None] * centre + (shapes[:, None] - 1) * ml - 1
            out[name] = np.where(np.isfinite(ll), ll, -np.inf).T
        elif name == "beta":
            ll = np.full((len(g), len(upper)), -np.inf)
            for i, a in enumerate(g):
                for j, b in enumerate(upper):
                    width = high - low + a + b
                    lx, lr, m, v = ml[i] - math.log(width), tops[j] - math.log(width), (mean - low + a) / width, (sd / width) ** 2
                    p, q = _fit_beta(lx, lr, m, v)
                    norm = math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q)
                    ll[i, j] = (p - 1) * lx + (q - 1) * lr - norm - math.log(width)
            out[name] = ll
    return out


def free_points(rows: DataFrame, m, names: Sequence[str]) -> dict[str, tuple[float, ...]]:
    """Per family the gap below the smallest value (and Weibull's shape, beta's gap above the largest one) of highest likelihood.

    Grids of candidates in logarithms, all families in one pass; each next grid lies between the neighbours of the best point. The
    likelihood of shapes below 1 grows without bound as the location nears the smallest value, so the gap is bounded (``GAP_RANGE``).
    """
    sd, low, high = m["sd"], m["low"], m["high"]
    gap = tuple(math.log(b * sd) for b in GAP_RANGE)
    shape = tuple(math.log(b) for b in SHAPE_RANGE)
    spans = {"lognorm": [gap], "gamma": [gap], "weibull_min": [gap, shape], "beta": [gap, gap]}
    spans = {k: v for k, v in spans.items() if k in names}
    bounds = {k: list(v) for k, v in spans.items()}
    blocks = pack(rows, ["x"])
    best: dict[str, tuple[float, ...]] = {}
    for _ in range(ZOOMS if spans else 0):
        grids = {k: [np.linspace(lo, hi, GRID if len(v) == 1 else PLANE) for lo, hi in v] for k, v in spans.items()}
        found = _profiles({k: tuple(np.exp(g) for g in v) for k, v in grids.items()}, m["mean"], low, high, sd, blocks)
        for k, ll in found.items():
            at = np.unravel_index(int(np.argmax(ll)), ll.shape)
            best[k] = tuple(float(np.exp(g[i])) for g, i in zip(grids[k], at))
            # Two steps to each side where two parameters pull together, one where a single one is sought.
            reach = 1 if len(at) == 1 else 3
            step = [g[1] - g[0] for g in grids[k]]
            spans[k] = [
                (max(b[0], g[i] - reach * d), min(b[1], g[i] + reach * d)) for g, i, d, b in zip(grids[k], at, step, bounds[k])
            ]
    return best


def fit_distributions(
    df: DataFrame,
    column: str = "price_min",
    names: Sequence[str] = ("norm", "lognorm", "expon", "gamma", "beta", "weibull_min"),
    free: bool = True,
) -> DataFrame:
    """Maximum-likelihood fits with their log-likelihood, AIC, BIC and Kolmogorov distance.

    The location is fitted too, within ``GAP_RANGE`` of the smallest value. With ``free`` false it is fixed (0; the padded range for beta)
    and positive families are left out when a value is not positive; the exponential starts at the minimum either way. ``n_params`` counts
    the fitted parameters. ``is_best`` marks the lowest AIC.
    """
    rows = df.select(F.col(column).cast("double").alias("x")).where(usable(F.col("x")))
    log_x = F.ln(F.when(F.col("x") > 0, F.col("x")))
    m = rows.agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("sd"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.avg(log_x).alias("mean_log"),
        F.stddev_pop(log_x).alias("sd_log"),
    ).first()
    x = F.col("x")
    fits: dict[str, tuple[dict[str, float], Column, Column]] = {}
    if m["n"] and m["sd"] > 0:
        fits = _fitted(rows, x, m, names, free_points(rows, m, names) if free else None)
    if not fits:
        return df.sparkSession.createDataFrame([], _FIT_SCHEMA)
    ladder = value_ladder(rows, "x").withColumnRenamed("value", "x")
    likelihood = rows.agg(*[F.sum(logpdf).alias(name) for name, (_, logpdf, _) in fits.items()])
    below, upto = F.col("below") / F.col("total"), (F.col("below") + F.col("ties")) / F.col("total")
    gaps = ladder.agg(
        *[
            F.max(F.greatest(cdf - below, upto - cdf)).alias(name)
            for name, (_, _, cdf) in fits.items()
        ]
    )
    ll, ks = likelihood.first(), gaps.first()
    best = min(fits, key=lambda name: (2 * len(fits[name][0]) - 2 * ll[name], name))
    out = []
    for name, (params, _, _) in fits.items():
        k = len(params)
        out.append(
            (
                name,
                {key: float(v) for key, v in params.items()},
                k,
                ll[name],
                2 * k - 2 * ll[name],
                k * math.log(m["n"]) - 2 * ll[name],
                ks[name],
                float(S.kolmogorov_tail(ks[name], m["n"])),
                name == best,
            )
        )
    return df.sparkSession.createDataFrame(out, _FIT_SCHEMA)


_FIT_SCHEMA = (
    "distribution string, parameters map<string,double>, n_params int, log_likelihood double, aic double, "
    "bic double, ks_statistic double, ks_p_value double, is_best boolean"
)


def _gamma_cdf(shape: float, scale: float):
    @F.pandas_udf("double")
    def cdf(x: pd.Series) -> pd.Series:
        return pd.Series(1 - gamma_tail(shape, x.to_numpy() / scale))

    return cdf


def _beta_cdf(a: float, b: float, low: float, width: float):
    @F.pandas_udf("double")
    def cdf(x: pd.Series) -> pd.Series:
        return pd.Series(beta_share(a, b, (x.to_numpy() - low) / width))

    return cdf


def _fitted(rows: DataFrame, x: Column, m, names: Sequence[str], points: dict[str, tuple[float, ...]] | None):
    """Name -> (parameters, log-density, distribution function) of the families that can be fitted; ``points`` holds the gaps
    between free locations and the smallest value."""
    root = 0.5 * math.log(2 * math.pi)
    positive = m["low"] > 0
    fits = {}

    def placed(name: str) -> tuple[float, dict[str, float]] | None:
        """The location, and the parameter it adds; None where the family cannot be fitted."""
        if name not in names or (points is None and not positive):
            return None
        return (0.0, {}) if points is None else (m["low"] - points[name][0], {"loc": m["low"] - points[name][0]})

    def mean_log(loc: float) -> tuple[float, float]:
        row = rows.agg(F.avg(F.ln(F.col("x") - loc)).alias("m"), F.stddev_pop(F.ln(F.col("x") - loc)).alias("s")).first()
        return row["m"], row["s"]

    if "norm" in names:
        z = (x - m["mean"]) / m["sd"]
        fits["norm"] = (
            {"loc": m["mean"], "scale": m["sd"]},
            -z * z / 2 - math.log(m["sd"]) - root,
            S.norm_cdf(z),
        )
    if place := placed("lognorm"):
        loc, extra = place
        centre, spread = mean_log(loc)
        if spread > 0:
            z = (F.ln(x - loc) - centre) / spread
            fits["lognorm"] = (
                {"s": spread, "scale": math.exp(centre)} | extra,
                -z * z / 2 - F.ln(x - loc) - math.log(spread) - root,
                S.norm_cdf(z),
            )
    if "expon" in names:
        scale = m["mean"] - m["low"]
        z = (x - m["low"]) / scale
        fits["expon"] = ({"loc": m["low"], "scale": scale}, -z - math.log(scale), 1 - F.exp(-z))
    if place := placed("gamma"):
        loc, extra = place
        shape, scale = _fit_gamma(m["mean"] - loc, mean_log(loc)[0])
        norm = math.lgamma(shape) + shape * math.log(scale)
        fits["gamma"] = (
            {"a": shape, "scale": scale} | extra,
            (shape - 1) * F.ln(x - loc) - (x - loc) / scale - norm,
            _gamma_cdf(shape, scale)(x - loc),
        )
    if "beta" in names:
        # With fixed ends the range is padded so that no value sits on an end, where the density is undefined.
        pad = ((m["high"] - m["low"]) * 1e-3,) * 2 if points is None else points["beta"]
        low, width = m["low"] - pad[0], m["high"] - m["low"] + pad[0] + pad[1]
        u = (x - low) / width
        s = rows.agg(
            F.avg(F.ln(u)).alias("lx"), F.avg(F.ln(1 - u)).alias("lr"), F.avg(u).alias("m"), F.var_pop(u).alias("v")
        ).first()
        a, b = _fit_beta(s["lx"], s["lr"], s["m"], s["v"])
        norm = math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b) + math.log(width)
        fits["beta"] = (
            {"a": a, "b": b, "loc": low, "scale": width},
            (a - 1) * F.ln(u) + (b - 1) * F.ln(1 - u) - norm,
            _beta_cdf(a, b, low, width)(x),
        )
    if place := placed("weibull_min"):
        loc, extra = place
        centre = mean_log(loc)[0]
        moved = rows.select((F.col("x") - loc).alias("x"))
        shape = _weibull_shape(moved, centre)
        power = moved.agg(F.avg(F.exp((F.ln("x") - centre) * shape))).first()[0]
        scale = math.exp(centre + math.log(power) / shape)
        lift = F.exp(shape * (F.ln(x - loc) - math.log(scale)))
        fits["weibull_min"] = (
            {"c": shape, "scale": scale} | extra,
            math.log(shape) - math.log(scale) + (shape - 1) * (F.ln(x - loc) - math.log(scale)) - lift,
            1 - F.exp(-lift),
        )
    return fits
