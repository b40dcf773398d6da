"""Cleaning, validation, scoring and audit of raw listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import listing as L
from marketloom.operators.lookup import lookup_join
from marketloom.schema import CITY_STATES, DEFAULT_STATE, DEFAULTS, LISTING_SCHEMA


def with_defaults(df: DataFrame) -> DataFrame:
    """Add absent optional fields. A field that is present but null stays null, and is rejected where required."""
    for name, value in DEFAULTS.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    if "tags" not in df.columns:
        df = df.withColumn("tags", F.array().cast("array<string>"))
    if "scraped_at" not in df.columns:
        df = df.withColumn("scraped_at", F.current_timestamp().cast("timestamp_ntz"))
    if "quality_score" not in df.columns:
        df = df.withColumn("quality_score", F.lit(1.0))
    for field in LISTING_SCHEMA:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df


def validate_listings(df: DataFrame) -> DataFrame:
    """All rows, each with ``is_valid`` and the names of the rules it breaks."""
    rules = L.validation_rules()
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("reject_reasons", broken).withColumn("is_valid", F.size("reject_reasons") == 0)


def score_listings(df: DataFrame) -> DataFrame:
    """Clean names and price text, then recompute the quality pair; any given score is replaced."""
    return (
        df.withColumn("product_name", L.clean_name(F.col("product_name")))
        .withColumn("price_raw", L.strip_or_null(F.col("price_raw")))
        .withColumn("quality_score", L.quality_score())
        .withColumn("is_complete", F.col("quality_score") >= 0.7)
    )


def accepted(df: DataFrame) -> DataFrame:
    """Valid listings, cleaned and scored."""
    return accepted_of(validate_listings(with_defaults(df)))


def accepted_of(judged: DataFrame) -> DataFrame:
    """The valid ones of validated listings, cleaned and scored."""
    return score_listings(judged.where("is_valid").drop("is_valid", "reject_reasons"))


def ingest_audit(df: DataFrame, by: str = "source") -> DataFrame:
    """Collected, validated and rejected counts of one ingest."""
    return audit_of(validate_listings(with_defaults(df)), by)


def audit_of(judged: DataFrame, by: str = "source") -> DataFrame:
    """Counts of validated listings."""
    return (
        judged.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("records_collected"),
            F.count_if("is_valid").alias("records_validated"),
            F.count_if(~F.col("is_valid")).alias("records_rejected"),
        )
        .withColumn("status", F.when(F.col("records_validated") > 0, "success").otherwise("failed"))
    )


def coerce_types(df: DataFrame) -> DataFrame:
    """Prices, score and rating as doubles (unparsable is missing), verified as a flag (missing is False)."""
    for column in ("price_min", "price_max", "quality_score", "supplier_rating"):
        if column in df.columns:
            df = df.withColumn(column, L.number_or_null(F.col(column)))
    if "supplier_verified" in df.columns:
        df = df.withColumn("supplier_verified", L.flag_or_false(F.col("supplier_verified")))
    return df


def city_state_lookup(
    df: DataFrame, states: dict[str, str] | DataFrame | None = None, default: str = DEFAULT_STATE
) -> DataFrame:
    """Add ``looked_up_state`` from the city; unknown cities get the default. ``states`` is a table (city, state) or a dictionary."""
    schema = T.StructType([T.StructField("city", T.StringType()), T.StructField("looked_up_state", T.StringType())])
    if isinstance(states, DataFrame):
        pairs = states.toDF(*schema.names)
    else:
        pairs = df.sparkSession.createDataFrame(list((states or CITY_STATES).items()), schema)
    joined = lookup_join(df, pairs, ["city"])
    return joined.withColumn("looked_up_state", F.coalesce("looked_up_state", F.lit(default)))


def normalize_raw(df: DataFrame, category: str | None = None) -> DataFrame:
    """The raw CSV layout as listing fields."""
    prices = L.price_bounds(F.col("price_info"))
    return df.select(
        "product_name",
        prices["price_min"].alias("price_min"),
        prices["price_max"].alias("price_max"),
        L.strip_or_null(F.col("price_info")).alias("price_raw"),
        "supplier_name",
        F.col("location").alias("city"),
        F.lit(category).cast("string").alias("category"),
        "source_url",
        F.col("timestamp").try_cast("timestamp_ntz").alias("scraped_at"),
    )
