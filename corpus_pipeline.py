"""The corpus pipeline: five stages from raw documents to a weighted mix, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and returns documents with all their columns (the last one adds the number of the copy);
it works on whatever its predecessor kept, whole texts, and its decisions take effect. Rows of one doc_id are judged by
the row's own text; identical rows are one document and leave near-dedup as one row.

A stage sets the session's size of Arrow batches (``BATCH_BYTES``), as executors otherwise hold 10,000 whole texts a batch on both sides of Python.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, mixing, near_dedup, pii, toxicity
from marketloom.session import shared_folder
from marketloom.sources.driver_tables import table


BATCH_BYTES = 4 << 20
ROW, HASH, COPIES = "__row", "__hash", "__copies"  # of tables made here; a document's columns of these names are left alone


def _row_code() -> F.Column:
    return F.xxhash64("doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples don't mark as toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    keyed = docs.select("doc_id", "text", _row_code().alias(ROW))
    toxic = toxicity.classify(keyed, labels).where(F.col("predicted") == 1).select(ROW).distinct()
    return docs.join(toxic, _row_code() == toxic[ROW], "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that with the smallest id; of identical rows, one."""
    found = near_dedup.components(docs.select("doc_id", "text"))
    gone = found.where(~F.col("kept")).select("doc_id", "code").distinct()

    def named(rows: DataFrame, by: DataFrame) -> F.Column:
        return rows["doc_id"].eqNullSafe(by["doc_id"]) & (F.xxhash64(rows["text"]) == by["code"])

    kept = docs.join(gone, named(docs, gone), "left_anti")
    repeated = found.where("kept").groupBy("doc_id", "code").count().where(F.col("count") > 1).select("doc_id", "code")
    single = kept.join(repeated, named(kept, repeated), "left_anti")
    several = kept.join(repeated, named(kept, repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(several)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows."""
    found = decontaminate.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("key").alias(ROW)).distinct()
    return docs.join(gone, _row_code() == gone[ROW], "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets, and n_chars counted again."""
    clean = pii.masked(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for, numbered by ``copy`` from 1."""
    chosen = mixing.mix(docs.select("doc_id", "text", "source")).where(F.col("copies") > 0)
    counts = chosen.groupBy(F.col("hash").alias(HASH)).agg(F.max("copies").alias(COPIES))  # rows of equal hash have equal counts
    joined = docs.join(counts, mixing.row_hash() == counts[HASH])
    copies = F.explode(F.sequence(F.lit(1), counts[COPIES]))
    return joined.select(*[docs[c] for c in docs.columns if c != "copy"], copies.alias("copy"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with texts sent to Python ``BATCH_BYTES`` at a time; the setting stays, as what it returns runs later."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("near_dedup", in_small_batches(drop_near_copies)),
    ("decontamination", in_small_batches(drop_contaminated)),
    ("pii", in_small_batches(mask_personal_data)),
    ("mixing", in_small_batches(mix_sources)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
