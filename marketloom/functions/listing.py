"""Column expressions for single listing fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.schema import PRICE_UNITS, SOURCES


def clean_name(name: Column) -> Column:
    """Collapse whitespace, then drop markup characters, then trim."""
    collapsed = F.trim(F.regexp_replace(name, r"(?U)[\s\x1c-\x1f]+", " "))
    return F.trim(F.regexp_replace(collapsed, r"[<>{}\[\]\\]", ""))


def strip_or_null(text: Column) -> Column:
    """Trimmed text; an empty string counts as missing, a blank one becomes empty."""
    return F.when(F.length(text) > 0, F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def price_bounds(text: Column) -> Column:
    """Struct (price_min, price_max) of all numbers in a price text; commas are separators of thousands."""
    numbers = F.transform(
        F.regexp_extract_all(F.regexp_replace(text, ",", ""), F.lit(r"([0-9]+[.]?[0-9]*)"), 1),
        lambda n: n.cast("double"),
    )
    return F.struct(F.array_min(numbers).alias("price_min"), F.array_max(numbers).alias("price_max"))


def _filled(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def quality_points() -> Column:
    """How many of the six completeness checks a listing passes."""
    checks = [
        F.coalesce(F.length(clean_name(F.col("product_name"))) > 10, F.lit(False)),
        F.col("price_min").isNotNull() | F.col("price_max").isNotNull(),
        _filled(F.col("supplier_name")),
        _filled(F.col("city")) | _filled(F.col("state")),
        _filled(F.col("description")),
        _filled(F.col("category")),
    ]
    points = F.lit(0)
    for check in checks:
        points = points + check.cast("int")
    return points


def quality_score() -> Column:
    return F.round(quality_points() / F.lit(6.0), 2)


def is_complete() -> Column:
    return quality_score() >= 0.7


def category_label(slug: Column) -> Column:
    """``industrial-pumps`` -> ``Industrial Pumps``."""
    return F.initcap(F.regexp_replace(slug, "-", " "))


def tags_text(tags: Column) -> Column:
    return F.concat_ws(",", tags)


def tags_list(text: Column) -> Column:
    """Comma text to list; missing or empty text is an empty list."""
    return F.when(F.length(text) > 0, F.split(text, ",", -1)).otherwise(F.array().cast("array<string>"))


def number_or_null(value: Column) -> Column:
    """Numeric coercion; anything unparsable, and NaN, is missing."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def flag_or_false(value: Column) -> Column:
    return F.coalesce(value.try_cast("boolean"), F.lit(False))


def log10_price(price: Column) -> Column:
    return F.log10(price + 1)


def price_label(price: Column) -> Column:
    """Headline price: thousands below one lakh, lakhs above."""
    return F.when(price < 100000, F.format_string("Rs %.0fK", price / 1000)).otherwise(
        F.format_string("Rs %.1fL", price / 100000)
    )


def bar_label(price: Column) -> Column:
    return F.when(price >= 1000, F.format_string("₹%.1fK", price / 1000)).otherwise(
        F.format_string("₹%.0f", price)
    )


def short_label(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)


def _at_most(column: str, length: int) -> Column:
    return F.col(column).isNull() | (F.length(column) <= length)


def _not_negative(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) >= 0)


def validation_rules() -> dict[str, Column]:
    """Rule name -> predicate that holds for an acceptable listing.

    Lengths apply to the raw text: cleaning runs after the length check, so a cleaned name may be shorter.
    """
    name, rating = F.col("product_name"), F.col("supplier_rating")
    return {
        "product_name": F.coalesce(F.length(name).between(3, 500), F.lit(False)),
        "description": _at_most("description", 5000),
        "price_min": _not_negative("price_min"),
        "price_max": _not_negative("price_max"),
        "supplier_name": _at_most("supplier_name", 300),
        "supplier_rating": rating.isNull() | rating.between(0, 5),
        "category": F.col("category").isNotNull(),
        "source": F.coalesce(F.col("source").isin(*SOURCES), F.lit(False)),
        "price_unit": F.coalesce(F.col("price_unit").isin(*PRICE_UNITS), F.lit(False)),
        "currency": F.col("currency").isNotNull(),
        "country": F.col("country").isNotNull(),
        "supplier_verified": F.col("supplier_verified").isNotNull(),
        "quality_score": F.coalesce(F.col("quality_score").between(0, 1), F.lit(False)),
    }
