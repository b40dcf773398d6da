"""Clustering features: derived prices, encodings, imputation and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.lookup import lookup_join, settled
from marketloom.operators.ranks import average_rank, melt, quantile_table, value_ladder
from marketloom.schema import FEATURE_COLUMNS


def engineer_features(df: DataFrame) -> DataFrame:
    """Add the twelve clustering features. All three encodings come from one aggregation per (category, city)."""
    cube = settled(
        df.groupBy("category", "city").agg(
            F.count(F.lit(1)).alias("n"), F.sum("price_min").alias("price"), F.count("price_min").alias("priced")
        )
    )
    categories = settled(
        cube.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.sum("n").alias("category_frequency"), F.try_divide(F.sum("price"), F.sum("priced")).alias("mean_price"))
    )
    ranks = value_ladder(categories, "mean_price").select(
        F.col("value").alias("mean_price"), average_rank().alias("category_price_rank")
    )
    category_codes = categories.join(ranks, "mean_price", "left").drop("mean_price")
    city_codes = cube.where(F.col("city").isNotNull()).groupBy("city").agg(F.sum("n").alias("city_frequency"))
    encoded = lookup_join(lookup_join(df, category_codes, ["category"]), city_codes, ["city"])
    low, high = F.col("price_min"), F.col("price_max")
    return (
        encoded.withColumn("price_range", high - low)
        .withColumn("price_mid", (low + high) / 2)
        .withColumn("log_price_min", F.log1p(low))
        .withColumn("log_price_max", F.log1p(high))
        .withColumn("price_ratio", high / (low + 1))
        .withColumn("price_volatility", F.col("price_range") / (F.col("price_mid") + 1))
        .withColumn("verified_int", F.coalesce(F.col("supplier_verified"), F.lit(False)).cast("int"))
    )


def impute_median(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Missing values become the column's exact median; only columns with a gap are ranked."""
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    missing = [c for c in columns if gaps[c]]
    if not missing:
        return df
    medians = {r["column"]: r["m"] for r in quantile_table(melt(df, missing), "value", {"m": 0.5}, ["column"]).collect()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))) for c in missing})


def scale_features(
    df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, method: str = "standard", key: str = "id"
) -> DataFrame:
    """Key and scaled columns: ``standard`` (population deviation), ``minmax`` or ``robust`` (median and quartiles).

    A column without spread is only shifted, so it becomes 0.
    """
    if method == "robust":
        table = quantile_table(melt(df, columns), "value", {"q1": 0.25, "m": 0.5, "q3": 0.75}, ["column"])
        found = {r["column"]: (r["m"], r["q3"] - r["q1"]) for r in table.collect()}
    else:
        centre, spread = (F.min, lambda c: F.max(c) - F.min(c)) if method == "minmax" else (F.avg, F.stddev_pop)
        row = df.agg(
            *[centre(c).alias(f"c_{c}") for c in columns], *[spread(c).alias(f"s_{c}") for c in columns]
        ).first()
        found = {c: (row[f"c_{c}"], row[f"s_{c}"]) for c in columns}
    scaled = []
    for c in columns:
        shift, width = found.get(c, (None, None))
        scaled.append(((F.col(c) - F.lit(shift).cast("double")) / F.lit(float(width or 1.0))).alias(c))
    return df.select(key, *scaled)


def feature_matrix(df: DataFrame, method: str = "standard", key: str = "id") -> DataFrame:
    """Engineered, imputed and scaled features of every listing."""
    return scale_features(impute_median(engineer_features(df)), FEATURE_COLUMNS, method, key)
