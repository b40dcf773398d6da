"""Tests of a measure across groups. Groups with a missing name or fewer than two values take no part."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import special as S
from marketloom.operators.groups import crosstab
from marketloom.operators.lookup import lookup_join, settled
from marketloom.operators.ranks import average_rank, exact_quantiles, labelled_ladder, usable

ALPHA = 0.05


def _grouped(df: DataFrame, value: str, group: str) -> DataFrame:
    """Rows (grp, value) of the groups that can be tested."""
    rows = df.select(F.col(group).alias("grp"), F.col(value).cast("double").alias("value"))
    rows = rows.where(usable(F.col("value")) & F.col("grp").isNotNull())
    large = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).where("size >= 2").select("grp")
    return lookup_join(rows, large, ["grp"], "inner")


def _group_moments(rows: DataFrame, value: str = "value") -> DataFrame:
    return settled(
        rows.groupBy("grp").agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg(value).alias("mean"),
            F.var_samp(value).alias("var"),
        )
    )


def _sums_of_squares(moments: DataFrame) -> DataFrame:
    """One row (k, n, ss_between, ss_within) from the group moments; fewer than two groups give no row."""
    grand = moments.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    gap = F.col("mean") - F.col("grand")
    return (
        moments.withColumn("grand", grand)
        .agg(
            F.count(F.lit(1)).cast("double").alias("k"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * gap * gap).alias("ss_between"),
            F.sum((F.col("n") - 1) * F.col("var")).alias("ss_within"),
        )
        .where("k >= 2")
    )


def _f_ratio() -> Column:
    return (F.col("ss_between") / (F.col("k") - 1)) / (F.col("ss_within") / (F.col("n") - F.col("k")))


def _significance(df: DataFrame, p: Column) -> DataFrame:
    return df.withColumn("p_value", p).withColumn("is_significant", F.col("p_value") < ALPHA)


def _size_label(measure: str, large: float, medium: float) -> Column:
    return F.when(F.col(measure) > large, "Large").when(F.col(measure) > medium, "Medium").otherwise("Small")


def anova(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    """One-way F test with eta and omega squared."""
    total = F.col("ss_between") + F.col("ss_within")
    error = F.col("ss_within") / (F.col("n") - F.col("k"))
    stats = (
        _sums_of_squares(_group_moments(_grouped(df, value, group)))
        .withColumn("f_statistic", _f_ratio())
        .withColumn("eta_squared", F.when(total > 0, F.col("ss_between") / total).otherwise(0.0))
        .withColumn(
            "omega_squared",
            F.when(total + error > 0, (F.col("ss_between") - (F.col("k") - 1) * error) / (total + error)).otherwise(0.0),
        )
    )
    tested = _significance(stats, S.f_p(F.col("f_statistic"), F.col("k") - 1, F.col("n") - F.col("k")))
    return tested.select(
        "f_statistic",
        "p_value",
        "is_significant",
        "eta_squared",
        "omega_squared",
        _size_label("eta_squared", 0.14, 0.06).alias("effect_size_interpretation"),
    )


def kruskal(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    """Rank test across groups, corrected for ties."""
    ladder = labelled_ladder(_grouped(df, value, group), "value", "grp")
    ties = F.col("ties").cast("double")
    per_group = ladder.groupBy("grp").agg(
        F.sum("cnt").cast("double").alias("n"),
        F.sum(F.col("cnt") * average_rank()).alias("rank_sum"),
        # Summed over the rows of a tie, this is t^3 - t.
        F.sum(F.col("cnt") * (ties * ties - 1)).alias("tie_term"),
    )
    n = F.col("n")
    stats = (
        per_group.agg(
            F.count(F.lit(1)).cast("double").alias("k"),
            F.sum("n").alias("n"),
            F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("squares"),
            F.sum("tie_term").alias("tie_term"),
        )
        .where("k >= 2")
        .withColumn(
            "h_statistic",
            (12 / (n * (n + 1)) * F.col("squares") - 3 * (n + 1)) / (1 - F.col("tie_term") / (n * n * n - n)),
        )
    )
    return _significance(stats, S.chi2_p(F.col("h_statistic"), F.col("k") - 1)).select(
        "h_statistic", "p_value", "is_significant"
    )


def _bucket_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Within one value bucket, for each ordered pair of groups: wins of a over b (ties count half) and the mixed part
    of the cubed tie sizes."""
    names, label = np.unique(pdf["grp"].to_numpy(dtype=object), return_inverse=True)
    _, place = np.unique(pdf["value"].to_numpy(), return_inverse=True)
    counts = np.zeros((place.max() + 1, len(names)))
    np.add.at(counts, (place, label), pdf["cnt"].to_numpy(dtype=float))
    below = np.cumsum(counts, axis=0) - counts
    wins = counts.T @ (below + counts / 2)
    square = (counts**2).T @ counts
    a, b = np.nonzero(~np.eye(len(names), dtype=bool))
    return pd.DataFrame(
        {"group_a": names[a], "group_b": names[b], "wins": wins[a, b], "mixed": 3 * (square[a, b] + square[b, a])}
    )


def mann_whitney_pairs(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    """U of the first group for every pair of groups in name order, with its two-sided p.

    Rows collapse to counts per (value, group). A pair's U is the sum of what happens inside each value bucket plus, for
    each bucket, its rows of a times the rows of b in lower buckets. The p-value is exact where no value is tied, the smaller group has
    at most 8 rows and the arrangements can be counted in 64 bits; else it is the normal approximation, corrected for ties and
    continuity.
    """
    ladder = labelled_ladder(_grouped(df, value, group), "value", "grp").select("bucket", "value", "grp", "cnt")
    sizes = settled(ladder.groupBy("bucket", "grp").agg(F.sum("cnt").cast("double").alias("size")))
    cube = F.col("cnt").cast("double")
    totals = settled(ladder.groupBy("grp").agg(F.sum(cube).alias("n"), F.sum(cube * cube * cube).alias("cubes")))
    inside = (
        ladder.groupBy("bucket")
        .applyInPandas(_bucket_pairs, "group_a string, group_b string, wins double, mixed double")
        .groupBy("group_a", "group_b")
        .agg(F.sum("wins").alias("wins"), F.sum("mixed").alias("mixed"))
    )
    # Every bucket against every group, from the per-bucket counts alone; the result has a row per pair anyway.
    names = [row["grp"] for row in totals.select("grp").collect()]
    in_bucket = sizes.groupBy("bucket").agg(
        F.map_from_entries(F.collect_list(F.struct("grp", "size"))).alias("by_group")
    )
    lower = Window.partitionBy("group_b").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    dense = (
        in_bucket.withColumn("group_b", F.explode(F.array(*[F.lit(n) for n in names]).cast("array<string>")))
        .withColumn("size_b", F.coalesce(F.try_element_at("by_group", F.col("group_b")), F.lit(0.0)))
        .withColumn("below_b", F.coalesce(F.sum("size_b").over(lower), F.lit(0.0)))
        .select("bucket", "group_b", "below_b")
    )
    across = (
        sizes.withColumnRenamed("grp", "group_a")
        .join(dense, "bucket")
        .where(F.col("group_a") < F.col("group_b"))
        .groupBy("group_a", "group_b")
        .agg(F.sum(F.col("size") * F.col("below_b")).alias("across"))
    )
    side = lambda s: totals.select(
        F.col("grp").alias(f"group_{s}"), F.col("n").alias(f"n_{s}"), F.col("cubes").alias(f"cubes_{s}")
    )
    pairs = (
        across.join(inside, ["group_a", "group_b"], "left")
        .join(side("a"), "group_a")
        .join(side("b"), "group_b")
        .withColumn("u_statistic", F.col("across") + F.coalesce("wins", F.lit(0.0)))
    )
    n, product = F.col("n_a") + F.col("n_b"), F.col("n_a") * F.col("n_b")
    ties = F.col("cubes_a") + F.col("cubes_b") + F.coalesce("mixed", F.lit(0.0)) - n
    spread = F.sqrt(product / 12 * (n + 1 - ties / (n * (n - 1))))
    larger = F.greatest("u_statistic", product - F.col("u_statistic"))
    z = F.try_divide(larger - product / 2 - 0.5, spread)
    exact = S.mann_whitney_p(F.col("u_statistic"), F.col("n_a"), F.col("n_b"), ties)
    return _significance(pairs, F.coalesce(exact, F.least(F.lit(1.0), 2 * S.norm_sf(z)))).select(
        "group_a", "group_b", "u_statistic", "p_value", "is_significant"
    )


# --- equality of variances ----------------------------------------------------------------------------------------------


def _deviations(df: DataFrame, value: str, group: str) -> DataFrame:
    """Distance of each value from its group's median."""
    rows = _grouped(df, value, group)
    medians = exact_quantiles(rows, "value", [0.5], ["grp"]).select("grp", F.col("quantile").alias("median"))
    centred = lookup_join(rows, medians, ["grp"])
    return centred.select("grp", F.abs(F.col("value") - F.col("median")).alias("value"))


def _variance_verdict(df: DataFrame, p: Column) -> DataFrame:
    return df.withColumn("p_value", p).select(
        "statistic", "p_value", (F.col("p_value") > ALPHA).alias("equal_variances")
    )


def levene(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    """F test on the distances from the group medians."""
    stats = _sums_of_squares(_group_moments(_deviations(df, value, group))).withColumn("statistic", _f_ratio())
    return _variance_verdict(stats, S.f_p(F.col("statistic"), F.col("k") - 1, F.col("n") - F.col("k")))


def bartlett(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    free = F.col("n") - 1
    stats = (
        _group_moments(_grouped(df, value, group))
        .agg(
            F.count(F.lit(1)).cast("double").alias("k"),
            F.sum(free).alias("free"),
            (F.sum(free * F.col("var")) / F.sum(free)).alias("pooled"),
            F.sum(free * F.ln("var")).alias("logs"),
            F.sum(1 / free).alias("inverse"),
        )
        .where("k >= 2")
        .withColumn(
            "statistic",
            (F.col("free") * F.ln("pooled") - F.col("logs"))
            / (1 + (F.col("inverse") - 1 / F.col("free")) / (3 * (F.col("k") - 1))),
        )
    )
    return _variance_verdict(stats, S.chi2_p(F.col("statistic"), F.col("k") - 1))


def fligner(df: DataFrame, value: str = "price_min", group: str = "category") -> DataFrame:
    """Normal scores of the ranked distances from the group medians."""
    ladder = labelled_ladder(_deviations(df, value, group), "value", "grp")
    share = 0.5 + average_rank() / (2 * (F.col("total") + 1))
    scored = S.with_norm_ppf(ladder, share, "score").withColumn("cnt", F.col("cnt").cast("double"))
    groups = settled(
        scored.groupBy("grp").agg(
            F.sum("cnt").alias("n"),
            F.sum(F.col("cnt") * F.col("score")).alias("total"),
            F.sum(F.col("cnt") * F.col("score") * F.col("score")).alias("squares"),
        )
    )
    grand = groups.agg(F.sum("total") / F.sum("n")).scalar()
    gap = F.col("total") / F.col("n") - F.col("grand")
    stats = (
        groups.withColumn("grand", grand)
        .agg(
            F.count(F.lit(1)).cast("double").alias("k"),
            F.sum(F.col("n") * gap * gap).alias("between"),
            ((F.sum("squares") - F.sum("n") * F.pow(F.max("grand"), F.lit(2))) / (F.sum("n") - 1)).alias("variance"),
        )
        .where("k >= 2")
        .withColumn("statistic", F.col("between") / F.col("variance"))
    )
    return _variance_verdict(stats, S.chi2_p(F.col("statistic"), F.col("k") - 1))


# --- contingency --------------------------------------------------------------------------------------------------------


def chi_square(df: DataFrame, first: str = "category", second: str = "supplier_verified") -> DataFrame:
    """Independence of two columns with Cramer's V; a 2 x 2 table is corrected for continuity.

    Cells with no rows are not listed: each adds its expected count, and all expected counts sum to the total.
    """
    cells = crosstab(df, first, second).select(
        F.col(first).alias("a"), F.col(second).alias("b"), F.col("count").cast("double").alias("o")
    )
    rows = cells.groupBy("a").agg(F.sum("o").alias("row"))
    cols = cells.groupBy("b").agg(F.sum("o").alias("col"))
    shape = rows.agg(F.count(F.lit(1)).cast("double").alias("r"), F.sum("row").alias("n"), F.sum(1 / F.col("row")).alias("ri"))
    wide = cols.agg(F.count(F.lit(1)).cast("double").alias("c"), F.sum(1 / F.col("col")).alias("ci"))
    expected = F.col("row") * F.col("col") / F.col("n")
    gap = F.col("o") - expected
    joined = cells.join(rows, "a").join(cols, "b").withColumn("n", shape.select("n").scalar())
    plain = joined.agg(
        F.sum(gap * gap / expected - expected).alias("listed"), F.max(F.abs(gap)).alias("gap")
    )
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    kept = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    corrected = kept * kept * F.col("n") * F.col("ri") * F.col("ci")
    smaller = F.least(F.col("r"), F.col("c")) - 1
    stats = (
        plain.select("*", *[shape.select(c).scalar().alias(c) for c in ("r", "n", "ri")],
                     *[wide.select(c).scalar().alias(c) for c in ("c", "ci")])
        .where("r >= 2 and c >= 2")
        .withColumn("degrees_of_freedom", dof)
        .withColumn("chi2_statistic", F.when(dof == 1, corrected).otherwise(F.col("listed") + F.col("n")))
        .withColumn("cramers_v", F.sqrt(F.col("chi2_statistic") / (F.col("n") * smaller)))
    )
    return _significance(stats, S.chi2_p("chi2_statistic", "degrees_of_freedom")).select(
        "chi2_statistic",
        "p_value",
        F.col("degrees_of_freedom").cast("long").alias("degrees_of_freedom"),
        "is_significant",
        "cramers_v",
        _size_label("cramers_v", 0.5, 0.3).alias("effect_size_interpretation"),
    )
