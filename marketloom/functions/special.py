"""Normal distribution as column expressions, and tail probabilities of the test statistics.

The normal functions stay in the JVM because they run over whole columns. Tail probabilities run over result tables of
a few rows per column pair, as pandas UDFs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rational approximations of erfc (W. J. Cody, Math. Comp. 23, 1969).
ERFC_SMALL = (
    (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2,
     3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
ERFC_MIDDLE = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1,
     2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3,
     1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
     3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
ERFC_LARGE = (
    (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
     1.60837851487422766e-2, 6.58749161529837803e-4),
    (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2,
     2.33520497626869185e-3),
)

# Normal quantile (M. J. Wichura, algorithm AS 241, Applied Statistics 37, 1988), highest power first.
PPF_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
PPF_TAIL = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
PPF_FAR_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


# Up to here the exact laws are used.
KOLMOGOROV_ROWS = 2000
MANN_WHITNEY_ROWS = 8

# Continued fractions need about sqrt(a) terms.
MAX_TERMS = 100_000


def polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    """Horner form, highest power first."""
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def _ratio(x: Column, pair: tuple[Sequence[float], Sequence[float]]) -> Column:
    return polynomial(x, pair[0]) / polynomial(x, pair[1])


def erfc(x: Column) -> Column:
    size = F.abs(x)
    square = size * size
    middle = F.exp(-square) * _ratio(size, ERFC_MIDDLE)
    inverse = 1 / square
    large = F.exp(-square) * (1 / math.sqrt(math.pi) - inverse * _ratio(inverse, ERFC_LARGE)) / size
    upper = F.when(size <= 4, middle).otherwise(large)
    return F.when(size <= 0.46875, 1 - x * _ratio(square, ERFC_SMALL)).otherwise(F.when(x > 0, upper).otherwise(2 - upper))


def norm_cdf(x: Column) -> Column:
    return erfc(-x / math.sqrt(2)) / 2


def norm_sf(x: Column) -> Column:
    return erfc(x / math.sqrt(2)) / 2


def log_norm_sf(x: Column) -> Column:
    """Log of the upper tail; the asymptotic series takes over where the tail underflows."""
    far = -x * x / 2 - F.ln(x) - 0.5 * math.log(2 * math.pi) + F.ln(1 - 1 / (x * x))
    return F.when(x > 30, far).otherwise(F.ln(norm_sf(x)))


def with_norm_ppf(df: DataFrame, p: Column, name: str) -> DataFrame:
    """Add the normal quantile of ``p``. Its inner terms are columns of their own, so each is computed once per row."""
    staged = df.withColumn("_p", p).withColumn("_r", F.sqrt(-F.ln(F.least(F.col("_p"), 1 - F.col("_p")))))
    centre, r = F.col("_p") - 0.5, F.col("_r")
    near = centre * _ratio(0.180625 - centre * centre, PPF_CENTRE)
    tail = F.when(r <= 5, _ratio(r - 1.6, PPF_TAIL)).otherwise(_ratio(r - 5, PPF_FAR_TAIL))
    value = F.when(F.abs(centre) <= 0.425, near).otherwise(F.when(centre < 0, -tail).otherwise(tail))
    return staged.withColumn(name, value).drop("_p", "_r")


# --- tails of the test statistics, on result rows ---------------------------------------------------------------------


def gamma_tail(a, x) -> np.ndarray:
    """Regularised upper incomplete gamma Q(a, x), elementwise."""
    a, x = (v.astype(float) for v in np.broadcast_arrays(a, x))
    out = np.where(np.isnan(a) | np.isnan(x), np.nan, 1.0)
    inner = x > 0
    scale = np.zeros_like(out)
    scale[inner] = np.exp(a[inner] * np.log(x[inner]) - x[inner] - _lgamma(a[inner]))
    series = inner & (x < a + 1)
    if series.any():
        term = 1 / a[series]
        total, step = term.copy(), a[series].copy()
        for _ in range(MAX_TERMS):
            step += 1
            term = term * x[series] / step
            total += term
            if (np.abs(term) <= np.abs(total) * 1e-16).all():
                break
        out[series] = 1 - scale[series] * total
    far = inner & (x >= a + 1)
    if far.any():
        # Continued fraction by Lentz's method.
        af, b = a[far], x[far] + 1 - a[far]
        c, d = np.full_like(b, 1e300), 1 / b
        h = d.copy()
        for i in range(1, MAX_TERMS):
            weight = -i * (i - af)
            b = b + 2
            d = 1 / _away_from_zero(weight * d + b)
            c = _away_from_zero(b + weight / c)
            h *= c * d
            if (np.abs(c * d - 1) < 1e-15).all():
                break
        out[far] = scale[far] * h
    return out


def beta_share(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), elementwise."""
    a, b, x = (v.astype(float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    y = np.clip(y, 0.0, 1.0)
    safe = np.where((y > 0) & (y < 1), y, 0.5)
    front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(safe) + q * np.log1p(-safe)) / p
    c, d = np.ones_like(p), 1 / _away_from_zero(1 - (p + q) * safe / (p + 1))
    h = d.copy()
    for m in range(1, MAX_TERMS):
        even = m * (q - m) * safe / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * safe / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d = 1 / _away_from_zero(1 + step * d)
            c = _away_from_zero(1 + step / c)
            h *= c * d
        if (np.abs(c * d - 1) < 1e-15).all():
            break
    share = np.where(y <= 0, 0.0, np.where(y >= 1, 1.0, front * h))
    return np.where(np.isnan(a + b + x), np.nan, np.where(swap, 1 - share, share))


def _lgamma(x: np.ndarray) -> np.ndarray:
    kinds, place = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) if v > 0 else math.nan for v in kinds])[place].reshape(x.shape)


def _away_from_zero(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) > 1e-300, x, 1e-300)


def chi2_tail(x, dof) -> np.ndarray:
    return gamma_tail(np.asarray(dof, dtype=float) / 2, np.asarray(x, dtype=float) / 2)


def chi2_upper_quantile(p: float, dof: int) -> float:
    """The x with upper tail p, by bisection."""
    low, high = 0.0, 1.0
    while chi2_tail(high, dof) > p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle, dof) > p else (low, middle)
    return (low + high) / 2


def f_tail(x, d1, d2) -> np.ndarray:
    x, d1, d2 = (np.asarray(v, dtype=float) for v in (x, d1, d2))
    return beta_share(d2 / 2, d1 / 2, d2 / (d2 + d1 * x))


def kolmogorov_tail(d, n) -> np.ndarray:
    """P(D >= d) for n values: the exact law up to ``KOLMOGOROV_ROWS`` values, beyond them the limit law with the usual
    finite-sample correction of the argument."""
    d, n = np.broadcast_arrays(np.asarray(d, dtype=float), np.asarray(n, dtype=float))
    x = (np.sqrt(n) + 0.12 + 0.11 / np.sqrt(n)) * d
    total = sum((-1) ** (k - 1) * np.exp(-2 * (k * x) ** 2) for k in range(1, 101))
    limit = np.where(np.isnan(x), np.nan, np.where(x < 0.2, 1.0, np.clip(2 * total, 0.0, 1.0)))
    out = np.array(limit)
    for at in np.ndindex(out.shape):
        if 1 <= n[at] <= KOLMOGOROV_ROWS and not np.isnan(d[at]):
            out[at] = _kolmogorov_exact(float(d[at]), int(n[at]))
    return out


def _kolmogorov_exact(d: float, n: int) -> float:
    """The exact upper tail, by the power of a banded matrix (Marsaglia, Tsang and Wang 2003)."""
    if d <= 0.5 / n:
        return 1.0
    if d >= 1:
        return 0.0
    if n * d * d > 18:  # both tails together are below 1e-15 then
        return 0.0
    k = math.floor(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    i, j = np.indices((m, m))
    matrix = (i - j + 1 >= 0).astype(float)
    steps = np.arange(1, m + 1)
    matrix[:, 0] -= h**steps
    matrix[-1, :] -= h ** steps[::-1]
    if 2 * h > 1:
        matrix[-1, 0] += (2 * h - 1) ** m
    factorial = np.array([math.lgamma(v + 1) for v in range(m + 1)])
    matrix *= np.where(i - j + 1 > 0, np.exp(-factorial[np.maximum(i - j + 1, 0)]), 1.0)
    # Square and multiply; the scale is kept apart as a logarithm.
    result, log_result, power, log_power, left = np.eye(m), 0.0, matrix, 0.0, n
    while left:
        if left & 1:
            result, log_result = result @ power, log_result + log_power
            scale = np.abs(result).max()
            result, log_result = result / scale, log_result + math.log(scale)
        left >>= 1
        if left:
            power, log_power = power @ power, 2 * log_power
            scale = np.abs(power).max()
            power, log_power = power / scale, log_power + math.log(scale)
    inside = result[k - 1, k - 1]
    if inside <= 0:
        return 1.0
    below = math.exp(min(0.0, math.log(inside) + log_result + math.lgamma(n + 1) - n * math.log(n)))
    return 1.0 - below


def mann_whitney_counts(a: int, b: int) -> np.ndarray:
    """How many arrangements of a and b untied values give each U, from 0 to a * b.

    The recursion over the sizes in product form: multiplied by 1 - q^(b+i) and divided by 1 - q^i for i = 1 .. a.
    """
    counts = np.zeros(a * b + 1, np.int64)
    counts[0] = 1
    for i in range(1, a + 1):
        if b + i <= a * b:
            counts[b + i :] -= counts[: -(b + i)].copy()
        for at in range(i):
            counts[at::i] = np.cumsum(counts[at::i])
    return counts


def mann_whitney_exact(u: float, a: float, b: float) -> float:
    """Exact two-sided p of U for untied groups; not a number where the arrangements are too many to be counted."""
    small, large = sorted((int(a), int(b)))
    if not 1 <= small <= MANN_WHITNEY_ROWS or math.comb(small + large, small) >= 1 << 62:
        return math.nan
    counts = mann_whitney_counts(small, large)
    tail = int(counts[math.ceil(max(u, a * b - u)) :].sum())
    return min(1.0, 2 * tail / math.comb(small + large, small))


def correlation_tail(r, n) -> np.ndarray:
    """Two-sided p of a Pearson correlation over n pairs."""
    r, n = np.asarray(r, dtype=float), np.asarray(n, dtype=float)
    enough = np.where(n > 2, n, np.nan)
    return beta_share((enough - 2) / 2, 0.5, np.clip(1 - r * r, 0.0, 1.0))


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(chi2_tail(x, dof))


@F.pandas_udf(T.DoubleType())
def f_p(x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_tail(x, d1, d2))


@F.pandas_udf(T.DoubleType())
def kolmogorov_p(d: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(kolmogorov_tail(d, n))


@F.pandas_udf(T.DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(correlation_tail(r, n))


@F.pandas_udf(T.DoubleType())
def mann_whitney_p(u: pd.Series, a: pd.Series, b: pd.Series, ties: pd.Series) -> pd.Series:
    """The exact p, null where it does not apply."""
    exact = [mann_whitney_exact(*row) if t == 0 else math.nan for *row, t in zip(u, a, b, ties)]
    return pd.Series(exact, dtype=float).replace(math.nan, None)
