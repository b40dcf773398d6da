"""Joins against small derived tables, with the size checked before anything is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import cut_lineage

LOOKUP_ROWS = 100_000


def bounded_local(df: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame | None:
    """``df`` evaluated into a local table if it has at most ``limit`` rows, else None."""
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return None
    return df.sparkSession.createDataFrame(table, df.schema)


def settled(df: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame:
    """A summary table evaluated once: local when counted to be small, else checkpointed.

    Needed where a derived floating-point key is joined with itself, and where several plans read one summary.
    """
    local = bounded_local(df, limit)
    return cut_lineage(df) if local is None else local


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int = LOOKUP_ROWS,
) -> DataFrame:
    """Join ``rows`` to a derived table without shuffling ``rows`` when that table is counted to be small.

    Beyond ``limit`` rows the join is left to the planner: a shuffled join whose hot keys AQE splits.
    """
    local = bounded_local(lookup, limit)
    return rows.join(lookup if local is None else F.broadcast(local), list(on), how)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with fewer partitions than cores dealt out evenly, for work that is heavy per row.

    A large table has more partitions than that and is left alone, so nothing big is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
