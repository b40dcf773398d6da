"""Session helpers: a configured session, and the shared folder for lineage cuts."""

from __future__ import annotations

import atexit
import shutil
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar
from urllib.parse import urlparse
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def build_session(app_name: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave ``master`` unset and let spark-submit decide."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder, as the cluster names it in ``spark.checkpoint.dir``; else one in the warehouse.

    On a local master the application's own subfolder in the warehouse is removed when the process ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/marketloom-cuts")
        if not configured and context.master.startswith("local"):
            atexit.register(shutil.rmtree, urlparse(context.getCheckpointDir()).path, ignore_errors=True)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Earlier rounds are never recomputed when an executor is lost. As a Parquet table the result keeps column pruning,
    and its size is known, so the planner broadcasts it when it is small.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parallel(tasks: Sequence[Callable[[], T]], threads: int = 4) -> list[T]:
    """Results of independent driver-side tasks whose Spark jobs may overlap, in order."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(threads, max(len(tasks), 1))) as pool:
        return pool.map(lambda run: run(), [inherit(t) for t in tasks])
