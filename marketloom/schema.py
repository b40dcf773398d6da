"""Listing schema and the fixed values of the listing record."""

from __future__ import annotations

from pyspark.sql import types as T

# Listing sources, price units, and defaults of optional fields.
SOURCES = ("indiamart", "alibaba", "tradeindia", "mock_generated")
PRICE_UNITS = ("per_piece", "per_set", "per_kg", "per_lot", "per_unit", "unknown")
DEFAULTS = {
    "currency": "INR",
    "country": "India",
    "price_unit": "unknown",
    "supplier_verified": False,
}

# State of each known city; other cities fall back to the default.
CITY_STATES = {
    "Mumbai": "Maharashtra",
    "Pune": "Maharashtra",
    "Nagpur": "Maharashtra",
    "Delhi": "Delhi",
    "Faridabad": "Haryana",
    "Ghaziabad": "Uttar Pradesh",
    "Ahmedabad": "Gujarat",
    "Rajkot": "Gujarat",
    "Surat": "Gujarat",
    "Vadodara": "Gujarat",
    "Chennai": "Tamil Nadu",
    "Coimbatore": "Tamil Nadu",
    "Bangalore": "Karnataka",
    "Hyderabad": "Telangana",
    "Kolkata": "West Bengal",
    "Ludhiana": "Punjab",
    "Jaipur": "Rajasthan",
    "Indore": "Madhya Pradesh",
}
DEFAULT_STATE = "Maharashtra"

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price_min", T.DoubleType()),
        T.StructField("price_max", T.DoubleType()),
        T.StructField("price_raw", T.StringType()),
        T.StructField("price_unit", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("supplier_name", T.StringType()),
        T.StructField("supplier_verified", T.BooleanType()),
        T.StructField("supplier_rating", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("scraped_at", T.TimestampNTZType()),
        T.StructField("is_complete", T.BooleanType()),
        T.StructField("quality_score", T.DoubleType()),
    ]
)

RAW_CSV_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("product_name", "price_info", "supplier_name", "location", "source_url", "timestamp")
    ]
)

NUMERIC_COLUMNS = ("price_min", "price_max", "supplier_rating", "quality_score")

FEATURE_COLUMNS = (
    "price_min",
    "price_max",
    "price_range",
    "price_mid",
    "log_price_min",
    "log_price_max",
    "price_ratio",
    "price_volatility",
    "category_frequency",
    "category_price_rank",
    "city_frequency",
    "verified_int",
)


def numeric_columns(schema: T.StructType, exclude: tuple[str, ...] = ("id",)) -> list[str]:
    """Numeric fields of a schema in order; keys are left out unless ``exclude`` is emptied."""
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
