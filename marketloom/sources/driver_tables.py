"""Views of the given tables in the listing layout."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import listing as L
from marketloom.operators.ranks import read_index, write_index
from marketloom.schema import DEFAULTS, NUMERIC_COLUMNS
from marketloom.session import shared_folder


ITEMS_PER_TASK = 500_000
LEAST_ITEMS = 1_000_000

_built: set[str] = set()
_building = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def build_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per offer (part, supplier): price range over its line items plus the dimension fields.

    Beyond ``LEAST_ITEMS`` line items are dealt once, by part, over as many tasks as their number asks for; they are aggregated and meet the
    parts where they are. The rest is left to the planner, which knows the file sizes.
    """
    unit_price = F.col("l_extendedprice") / F.col("l_quantity")
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"
    )
    count = items.count()
    if count > LEAST_ITEMS:
        items = items.repartition(max(-(-count // ITEMS_PER_TASK), spark.sparkContext.defaultParallelism), "l_partkey")
    offers = (
        items.groupBy("l_partkey", "l_suppkey")
        .agg(
            F.min(unit_price * (1 - F.col("l_discount"))).alias("price_min"),
            F.max(unit_price * (1 + F.col("l_tax"))).alias("price_max"),
            F.max("l_shipdate").alias("scraped_at"),
        )
    )
    joined = (
        offers.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    rupees = lambda c: F.format_number(F.floor(c), 0)
    return (
        joined.select(
            (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("id"),
            F.col("p_name").alias("product_name"),
            F.when(F.col("p_size") % 5 != 0, F.concat_ws(" ", "p_brand", "p_type", "p_name")).alias("description"),
            "price_min",
            "price_max",
            F.concat(F.lit("Rs "), rupees("price_min"), F.lit(" - Rs "), rupees("price_max")).alias("price_raw"),
            F.lit(DEFAULTS["price_unit"]).alias("price_unit"),
            F.lit(DEFAULTS["currency"]).alias("currency"),
            F.col("s_name").alias("supplier_name"),
            (F.col("s_acctbal") > 3000).alias("supplier_verified"),
            F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.col("s_acctbal") / 2000)).alias("supplier_rating"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lit(DEFAULTS["country"]).alias("country"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.split(F.concat(F.lower("p_type"), F.lit(","), F.lower("p_brand")), ",").alias("tags"),
            F.lit("mock_generated").alias("source"),
            F.lit("mock_generated").alias("source_url"),
            "scraped_at",
        )
        .withColumn("quality_score", L.quality_score())
        .withColumn("is_complete", L.is_complete())
    )


def _once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None]) -> str:
    """The folder of a table that is written once per application and given folder.

    It is a written table in the shared folder rather than a cache, so it survives lost executors and keeps Parquet
    pruning for every query that reads it.
    """
    digest = hashlib.sha256(f"{spark.sparkContext.applicationId}|{sf_dir}".encode()).hexdigest()[:16]
    path = f"{shared_folder(spark)}/{kind}-{digest}"
    with _building:  # threads of one application build it once
        if path not in _built:
            write(path)
            _built.add(path)
    return path


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored listing table: built once per application and folder, then read back column by column."""
    return spark.read.parquet(_once(spark, sf_dir, "listings", lambda path: build_listings(spark, sf_dir).write.mode("overwrite").parquet(path)))


def listing_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order statistics of the listings' numeric columns, stored once like the listings themselves."""
    df = listings(spark, sf_dir)
    return read_index(spark, _once(spark, sf_dir, "listing-index", lambda path: write_index(df, NUMERIC_COLUMNS, path)))


def document_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, unvalidated listings made of whole documents: long names, long descriptions and ratings out of range."""
    length = F.col("n_chars").cast("double")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("product_name"),
        F.col("text").alias("description"),
        length.alias("price_min"),
        (length * 2).alias("price_max"),
        F.concat(F.lit("Rs "), F.col("n_chars").cast("string")).alias("price_raw"),
        F.lit(DEFAULTS["price_unit"]).alias("price_unit"),
        F.lit(DEFAULTS["currency"]).alias("currency"),
        F.col("source").alias("supplier_name"),
        F.lit(DEFAULTS["supplier_verified"]).alias("supplier_verified"),
        (length / 1000).alias("supplier_rating"),
        F.col("lang").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lit(DEFAULTS["country"]).alias("country"),
        F.col("lang").alias("category"),
        F.lit("mock_generated").alias("source"),
        F.lit(1.0).alias("quality_score"),
    )
