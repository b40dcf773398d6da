"""Continuous ingestion: each micro-batch of raw listings is validated and appended as one batch of the collector."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marketloom.operators.ingest import accepted
from marketloom.sources.store import append_listings


def ingest_stream(raw: DataFrame, table_path: str, checkpoint_path: str) -> StreamingQuery:
    """Micro-batches go through the writer of batches, each under a name made of the checkpoint and its number, so one that is
    tried again after a failure replaces itself, and stream and batches share a table.

    Processes what is available and stops; run it on a schedule, or again after a failure.
    """
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:16]

    def append(batch: DataFrame, number: int) -> None:
        append_listings(accepted(batch), table_path, f"stream-{stream}-{number}")

    return (
        raw.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
