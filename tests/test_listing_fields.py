import pytest
from pyspark.sql import functions as F

from marketloom.functions import listing as L
from marketloom.operators import ingest
from marketloom.sources.driver_tables import document_listings  # noqa: F401 - import check


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, clean",
    [("  Gear   Pump ", "Gear Pump"), ("a < b", "a  b"), ("<b>{x}[y]\\", "bxy"), ("a \tb\n", "a b"), ("<>", "")],
)
def test_clean_name(spark, raw, clean):
    assert one(spark, raw, L.clean_name) == clean


@pytest.mark.parametrize(
    "raw, low, high",
    [
        ("₹ 1,200 - ₹ 900", 900.0, 1200.0),
        ("Rs 4.", 4.0, 4.0),
        ("100-200", 100.0, 200.0),
        ("1,200.50", 1200.5, 1200.5),
        ("call", None, None),
        ("", None, None),
        (None, None, None),
        ("5 to 7 or 3", 3.0, 7.0),
    ],
)
def test_price_bounds(spark, raw, low, high):
    got = one(spark, raw, L.price_bounds)
    assert (got["price_min"], got["price_max"]) == (low, high)


def test_strip_tags_and_labels(spark):
    assert one(spark, "  x ", L.strip_or_null) == "x"
    assert one(spark, "", L.strip_or_null) is None
    assert one(spark, "   ", L.strip_or_null) == ""
    assert one(spark, "a,b", L.tags_list) == ["a", "b"]
    assert one(spark, "", L.tags_list) == []
    assert one(spark, None, L.tags_list) == []
    assert one(spark, "industrial-pumps", L.category_label) == "Industrial Pumps"
    assert one(spark, 45_000.0, L.price_label, "double") == "Rs 45K"
    assert one(spark, 250_000.0, L.price_label, "double") == "Rs 2.5L"
    assert one(spark, 999.0, L.bar_label, "double") == "₹999"
    assert one(spark, "12.5", L.number_or_null) == 12.5
    assert one(spark, "12,5", L.number_or_null) is None
    assert one(spark, "NaN", L.number_or_null) is None
    assert one(spark, None, L.flag_or_false) is False


GOOD = dict(
    product_name="Gear Pump 9000",
    description="d",
    price_min=1.0,
    price_max=2.0,
    supplier_name="s",
    supplier_rating=4.0,
    city="Pune",
    category="Pumps",
    source="alibaba",
)
SCHEMA = (
    "product_name string, description string, price_min double, price_max double, supplier_name string, "
    "supplier_rating double, city string, category string, source string"
)


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"product_name": "ab"}, ["product_name"]),
        ({"product_name": "abc"}, []),
        ({"product_name": "x" * 500}, []),
        ({"product_name": "x" * 501}, ["product_name"]),
        ({"product_name": None}, ["product_name"]),
        ({"description": "x" * 5001}, ["description"]),
        ({"price_min": -1.0}, ["price_min"]),
        ({"price_min": 5.0, "price_max": 1.0}, []),
        ({"supplier_rating": 5.1}, ["supplier_rating"]),
        ({"supplier_name": "x" * 301}, ["supplier_name"]),
        ({"source": "elsewhere"}, ["source"]),
        ({"category": None}, ["category"]),
        ({"price_min": None, "price_max": None, "description": None, "city": None}, []),
        ({"category": None, "source": None}, ["category", "source"]),
    ],
)
def test_validation(spark, change, reasons):
    df = spark.createDataFrame([tuple((GOOD | change).values())], SCHEMA)
    got = ingest.validate_listings(ingest.with_defaults(df)).first()
    assert (got["reject_reasons"], got["is_valid"]) == (reasons, not reasons)


def test_null_in_required_optional_field_is_rejected(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], SCHEMA).withColumn("currency", F.lit(None).cast("string"))
    assert ingest.validate_listings(ingest.with_defaults(df)).first()["reject_reasons"] == ["currency"]


@pytest.mark.parametrize(
    "change, score, complete",
    [
        ({}, 1.0, True),
        ({"product_name": "Short name"}, 0.83, True),
        ({"product_name": "Short name", "description": None}, 0.67, False),
        ({"price_min": None}, 1.0, True),
        ({"price_min": None, "price_max": None, "city": "", "description": ""}, 0.5, False),
    ],
)
def test_quality(spark, change, score, complete):
    df = spark.createDataFrame([tuple((GOOD | change).values())], SCHEMA)
    got = ingest.score_listings(ingest.with_defaults(df)).first()
    assert (got["quality_score"], got["is_complete"]) == (score, complete)


def test_audit_counts(spark):
    rows = [tuple(GOOD.values()), tuple((GOOD | {"product_name": "x"}).values())]
    got = ingest.ingest_audit(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got["records_collected"], got["records_validated"], got["records_rejected"]) == (2, 1, 1)


def test_city_state_default(spark):
    df = spark.createDataFrame([("Surat",), ("Oslo",), (None,)], "city string")
    got = {r["city"]: r["looked_up_state"] for r in ingest.city_state_lookup(df).collect()}
    assert got == {"Surat": "Gujarat", "Oslo": "Maharashtra", None: "Maharashtra"}
