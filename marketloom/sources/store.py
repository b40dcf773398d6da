"""Listing storage: Parquet table partitioned by category, CSV import and export, ingest audit."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import listing as L
from marketloom.schema import LISTING_SCHEMA, RAW_CSV_SCHEMA

# Tags are stored as comma text, as in the exported CSV.
STORED_SCHEMA = T.StructType(
    [T.StructField("tags", T.StringType()) if f.name == "tags" else f for f in LISTING_SCHEMA]
)

# Folder of each batch, above the categories.
BATCH = "ingest_batch"

# Columns of a stored listing that readers get.
SCAN_COLUMNS = tuple(f.name for f in LISTING_SCHEMA if f.name not in ("product_id", "is_complete"))


def _stored(df: DataFrame) -> DataFrame:
    if isinstance(df.schema["tags"].dataType, T.ArrayType):
        df = df.withColumn("tags", L.tags_text(F.col("tags")))
    return df.select([c for c in LISTING_SCHEMA.names if c in df.columns])


def scan_listings(df: DataFrame) -> DataFrame:
    """Stored rows as readers get them: tags as a list, the timestamp as a timestamp."""
    tags = F.col("tags") if isinstance(df.schema["tags"].dataType, T.ArrayType) else L.tags_list(F.col("tags"))
    return df.withColumn("tags", F.coalesce(tags, F.array().cast("array<string>"))).select(
        [c for c in SCAN_COLUMNS if c in df.columns]
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(path).select(*STORED_SCHEMA.names)


def append_listings(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Add one batch in one job commit. A batch written again under its name replaces itself, so a repeated attempt adds nothing.

    Rows are not regrouped by category before the write, so a category with a third of all rows is written by many
    tasks.
    """
    named = _stored(df).withColumn(BATCH, F.lit(batch or f"batch-{uuid4().hex}"))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH, "category").parquet(path)


def replace_listings(df: DataFrame, path: str) -> None:
    """Replace the whole table; an empty DataFrame clears it."""
    named = _stored(df).withColumn(BATCH, F.lit(f"batch-{uuid4().hex}"))
    named.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BATCH, "category").parquet(path)


def listings_by_category(df: DataFrame, category: str) -> DataFrame:
    """Equality filter; on the stored table it prunes to one partition."""
    return df.where(F.col("category") == category)


def write_csv(df: DataFrame, path: str) -> None:
    """Files are compressed: a row's text is several times its share of a Parquet table, and a file is read as a whole anyway."""
    _stored(df).write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """An exported CSV with the listing schema; malformed fields become null."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([STORED_SCHEMA[n] if n in STORED_SCHEMA.names else T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
    return reader.option("multiLine", True).csv(path)


def load_listings(spark: SparkSession, table_path: str, csv_path: str) -> DataFrame:
    """The stored table, or the CSV when the table is missing or empty."""
    try:
        stored = read_table(spark, table_path)
        if not stored.isEmpty():
            return scan_listings(stored)
    except AnalysisException:
        pass
    return scan_listings(read_csv(spark, csv_path))


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw collection layout, all text."""
    return spark.read.schema(RAW_CSV_SCHEMA).option("header", True).option("escape", '"').csv(path)


def append_audit(audit: DataFrame, path: str) -> None:
    """Append ingest counters with the time of the run."""
    audit.withColumn("run_at", F.current_timestamp()).write.mode("append").parquet(path)
