"""SQL text of the normal distribution, for engines without error functions."""

from __future__ import annotations

from marketloom.functions.special import ERFC_LARGE, ERFC_MIDDLE, ERFC_SMALL, PPF_CENTRE, PPF_FAR_TAIL, PPF_TAIL


def poly(x: str, coefficients: tuple[float, ...]) -> str:
    out = f"{coefficients[0]!r}::double"
    for c in coefficients[1:]:
        out = f"({out}*({x})+({c!r}::double))"
    return out


def ratio(x: str, pair) -> str:
    return f"({poly(x, pair[0])}/{poly(x, pair[1])})"


def erfc(x: str) -> str:
    size, square = f"abs({x})", f"(({x})*({x}))"
    inverse = f"(1.0/{square})"
    middle = f"(exp(-{square})*{ratio(size, ERFC_MIDDLE)})"
    large = f"(exp(-{square})*(1/sqrt(pi())-{inverse}*{ratio(inverse, ERFC_LARGE)})/{size})"
    upper = f"(case when {size}<=4 then {middle} else {large} end)"
    small = f"(1-({x})*{ratio(square, ERFC_SMALL)})"
    return f"(case when {size}<=0.46875 then {small} when ({x})>0 then {upper} else 2-{upper} end)"


def cdf(x: str) -> str:
    return f"({erfc(f'(-({x})/sqrt(2.0))')}/2)"


def sf(x: str) -> str:
    return f"({erfc(f'(({x})/sqrt(2.0))')}/2)"


def ppf(p: str) -> str:
    q = f"(({p})-0.5)"
    r = f"sqrt(-ln(least({p},1-({p}))))"
    near = f"({q}*{ratio(f'(0.180625-{q}*{q})', PPF_CENTRE)})"
    tail = f"(case when {r}<=5 then {ratio(f'({r}-1.6)', PPF_TAIL)} else {ratio(f'({r}-5)', PPF_FAR_TAIL)} end)"
    return f"(case when abs({q})<=0.425 then {near} when {q}<0 then -{tail} else {tail} end)"


def chi2_sf(x: str, dof: str) -> str:
    """Upper tail of the chi-square law, as the finite sum that integer degrees of freedom allow."""
    even = f"list_sum(list_transform(range(0, cast({dof} AS bigint) // 2), lambda i: exp(i*ln({x}/2)-lgamma(i+1)-{x}/2)))"
    odd = (
        f"{erfc(f'sqrt({x}/2)')}+coalesce(list_sum(list_transform(range(1, (cast({dof} AS bigint)+1) // 2), "
        f"lambda i: exp((i-0.5)*ln({x}/2)-lgamma(i+0.5)-{x}/2))),0)"
    )
    return f"(case when {x}<=0 then 1.0 when cast({dof} AS bigint)%2=0 then {even} else {odd} end)"


def beta_share(x: str, a: str, b: str, steps: int = 12_000, width: float = 0.005) -> str:
    """Regularised incomplete beta function by Simpson's rule in z, where the variable of the integral is x*exp(-z/a)."""
    weight = f"(case when i=0 or i={steps} then 1 when i%2=1 then 4 else 2 end)"
    term = f"{weight}*exp({a}*ln({x})-(lgamma({a})+lgamma({b})-lgamma({a}+{b}))-i*{width})*power(1-{x}*exp(-i*{width}/{a}),{b}-1)"
    return f"(case when {x}<=0 then 0.0 else list_sum(list_transform(range(0, {steps}+1), lambda i: {term}))*{width}/3/({a}) end)"


def f_sf(f: str, d1: str, d2: str) -> str:
    return beta_share(f"(({d2})/(({d2})+({d1})*({f})))", f"(({d2})/2.0)", f"(({d1})/2.0)")


def correlation_p(r: str, n: str, steps: int = 2000) -> str:
    """Two-sided p of a correlation over n pairs: Simpson's rule on cos(t)^(n-3) from the angle of r up to where nothing is left."""
    low = f"asin(least(1.0, abs({r})))"
    width = f"((least(pi()/2, {low} + 40/sqrt({n}-2.0)) - {low})/{steps})"
    weight = f"(case when i=0 or i={steps} then 1 when i%2=1 then 4 else 2 end)"
    term = f"{weight}*power(greatest(cos({low}+i*{width}), 0.0), {n}-3)"
    whole = f"exp(lgamma(0.5)+lgamma(({n}-2)/2.0)-lgamma(({n}-1)/2.0))"
    return f"least(1.0, 2*list_sum(list_transform(range(0, {steps}+1), lambda i: {term}))*{width}/3/{whole})"


def kolmogorov_sf(d: str, n: str) -> str:
    """The limit law with the finite-sample correction of its argument."""
    x = f"((sqrt({n})+0.12+0.11/sqrt({n}))*({d}))"
    terms = f"list_sum(list_transform(range(1, 101), lambda k: (case when k%2=1 then 1 else -1 end)*exp(-2*power(k*{x}, 2))))"
    return f"(case when {x}<0.2 then 1.0 else least(1.0, greatest(0.0, 2*{terms})) end)"


def kolmogorov_exact(source: str) -> str:
    """CTEs that add ``p_value`` to one row (d, n) of ``source``: a Poisson process of rate n stays inside the band d around the diagonal.

    Its count is at most m - 1 at m/n - d and at least m + 1 at m/n + d; between these places it grows by independent steps.
    """
    return f"""
    places AS (SELECT row_number() OVER (ORDER BY t) AS j, t, t - coalesce(lag(t) OVER (ORDER BY t), 0) AS gap, low, high FROM (
      SELECT m / n - d AS t, 0 AS low, m - 1 AS high FROM {source}, range(1, n + 1) AS r(m) WHERE m / n - d > 0
      UNION ALL SELECT m / n + d, m + 1, n FROM {source}, range(0, n) AS r(m) WHERE m / n + d < 1
      UNION ALL SELECT 1.0, n, n FROM {source})),
    path AS (SELECT 0 AS j, [1.0::double] || list_transform(range(0, n), lambda x: 0.0::double) AS p, n FROM {source}
      UNION ALL SELECT places.j, list_transform(range(0, n + 1), lambda x: CASE WHEN x BETWEEN low AND high THEN
        list_sum(list_transform(range(0, x + 1), lambda k: p[k + 1] * exp((x - k) * ln(greatest(n * gap, 1e-300)) - n * gap - lgamma(x - k + 1))))
        ELSE 0.0::double END), n
      FROM path JOIN places ON places.j = path.j + 1),
    kolmogorov AS (SELECT 1 - arg_max(p, j)[any_value(n) + 1] / exp(any_value(n) * ln(any_value(n)) - any_value(n) - lgamma(any_value(n) + 1))
      AS p_value FROM path)"""
