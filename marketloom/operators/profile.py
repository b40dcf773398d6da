"""Descriptive statistics: one tidy row per numeric column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.groups import dedup_count, drop_nested
from marketloom.operators.lookup import lookup_join, settled
from marketloom.operators.ranks import column_ladder, exact_quantiles, ladder_quantiles, melt, ordered_weighted_means, quantile_table


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, column kinds, missing cells and duplicate rows of the flat columns."""
    flat = drop_nested(df)
    numeric = [f.name for f in flat.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in flat.schema if isinstance(f.dataType, T.StringType)]
    missing = F.lit(0).cast("long")
    for column in flat.columns:
        missing = missing + F.count_if(F.col(column).isNull())
    cells = F.col("total_records") * len(flat.columns)
    duplicates = dedup_count(flat).select("duplicate_rows").scalar()
    return flat.agg(F.count(F.lit(1)).alias("total_records"), missing.alias("missing_values")).select(
        "total_records",
        F.lit(len(flat.columns)).cast("long").alias("total_columns"),
        F.lit(len(numeric)).cast("long").alias("numeric_columns"),
        F.lit(len(text)).cast("long").alias("categorical_columns"),
        "missing_values",
        F.round(F.try_divide(F.col("missing_values") * 100, cells), 2).alias("missing_percentage"),
        duplicates.alias("duplicate_rows"),
    )


def _trimmed(share: float) -> Column:
    """Mean after cutting floor(share * n) rows off each end, from ladder rows."""
    cut = F.floor(F.lit(share) * F.col("total"))
    first = F.greatest(F.col("below"), cut)
    last = F.least(F.col("below") + F.col("ties"), F.col("total") - cut)
    kept = F.greatest(last - first, F.lit(0))
    return F.sum(F.col("value") * kept) / F.sum(kept)


def central_tendency(df: DataFrame, columns: Sequence[str], key: str = "id", index: DataFrame | None = None) -> DataFrame:
    """Means, median and mode per column; the weighted mean weighs rows 1..n in key order."""
    ladder = column_ladder(df, columns, index)
    positive = F.min("value") > 0
    ordered = ladder.groupBy("column").agg(
        F.sum("ties").alias("n"),
        (F.sum(F.col("value") * F.col("ties")) / F.sum("ties")).alias("mean"),
        # Most frequent value, the smallest on ties.
        F.max_by("value", F.struct("ties", -F.col("value"))).alias("mode"),
        _trimmed(0.1).alias("trimmed_mean_10"),
        _trimmed(0.2).alias("trimmed_mean_20"),
        F.when(
            positive, F.exp(F.sum(F.ln(F.when(F.col("value") > 0, F.col("value"))) * F.col("ties")) / F.sum("ties"))
        ).alias("geometric_mean"),
        F.when(positive, F.sum("ties") / F.sum(F.try_divide(F.col("ties"), F.col("value")))).alias("harmonic_mean"),
        *ladder_quantiles({"median": 0.5}),
    )
    weighted = ordered_weighted_means(df, columns, key)
    return ordered.join(F.broadcast(weighted), "column")  # one row per named column


def _quantiles(df: DataFrame, columns: Sequence[str], named: dict[str, float], index: DataFrame | None) -> DataFrame:
    """(column, one quantile per name)."""
    if index is None:
        return quantile_table(melt(df, columns), "value", named, ["column"]).drop("n")
    return column_ladder(df, columns, index).groupBy("column").agg(*ladder_quantiles(named))


def dispersion(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """Variance, spread and robust spread per column; ratios to a zero mean are null."""
    long = melt(df, columns)
    quartiles = settled(_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, index))
    values = long.withColumn("ties", F.lit(1)) if index is None else column_ladder(df, columns, index)
    centred = lookup_join(values, quartiles.select("column", "median"), ["column"]).withColumn(
        "deviation", F.abs(F.col("value") - F.col("median"))
    )
    mad = exact_quantiles(centred, "deviation", [0.5], ["column"], weight="ties").select("column", F.col("quantile").alias("mad"))
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("variance"),
        F.stddev_samp("value").alias("std_dev"),
        (F.max("value") - F.min("value")).alias("range"),
    )
    iqr = F.col("q3") - F.col("q1")
    return (
        moments.join(F.broadcast(quartiles.drop("median")), "column")  # one row per named column
        .join(F.broadcast(mad), "column")
        .select(
            "column",
            "variance",
            "std_dev",
            (F.col("std_dev") / F.sqrt("n")).alias("std_error"),
            "range",
            iqr.alias("iqr"),
            "mad",
            F.try_divide(F.col("std_dev"), F.col("mean")).alias("_cv"),
            (iqr / 2).alias("quartile_deviation"),
            F.try_divide(F.col("range"), F.col("mean")).alias("range_to_mean_ratio"),
        )
        .withColumn("coefficient_of_variation", F.col("_cv") * 100)
        .drop("_cv")
    )


def _label(measure: str, near: str, above: str, below: str) -> Column:
    value = F.col(measure)
    return F.when(F.abs(value) < 0.5, near).when(value > 0, above).when(value <= 0, below)


def shape(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """Skewness, excess kurtosis and quartile skewness with their labels; needs more than three values."""
    long = melt(df, columns)
    quartiles = _quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, index)
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("kurtosis"),
    )
    return (
        moments.where(F.col("n") > 3)
        .join(F.broadcast(quartiles), "column")  # one row per named column
        .select(
            "column",
            "skewness",
            _label(
                "skewness", "Approximately Symmetric", "Right-Skewed (Positive)", "Left-Skewed (Negative)"
            ).alias("skewness_interpretation"),
            "kurtosis",
            _label(
                "kurtosis", "Mesokurtic (Normal-like)", "Leptokurtic (Heavy-tailed)", "Platykurtic (Light-tailed)"
            ).alias("kurtosis_interpretation"),
            F.try_divide(
                F.col("q3") + F.col("q1") - 2 * F.col("median"), F.col("q3") - F.col("q1")
            ).alias("bowley_skewness"),
        )
    )


def position(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """Extremes, percentiles and deciles per column."""
    named = {f"p{p}": p / 100 for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)}
    named |= {f"d{d}": d / 10 for d in range(1, 10)}
    ends = (F.min("value").alias("min"), F.max("value").alias("max"))
    if index is not None:
        return column_ladder(df, columns, index).groupBy("column").agg(*ends, *ladder_quantiles(named))
    return melt(df, columns).groupBy("column").agg(*ends).join(F.broadcast(_quantiles(df, columns, named, index)), "column")
