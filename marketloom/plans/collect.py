"""Collect: raw pages or raw rows -> validated, scored listings in the store, with audit counters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketloom.operators.ingest import accepted_of, audit_of, validate_listings, with_defaults
from marketloom.session import cut_lineage
from marketloom.sources.pages import extract_listings
from marketloom.sources.store import append_audit, append_listings, write_csv


def store_listings(raw: DataFrame, table_path: str, audit_path: str | None = None, csv_path: str | None = None) -> None:
    """Append the acceptable rows of one batch, and its counters; the batch is evaluated once, into a written table."""
    judged = cut_lineage(validate_listings(with_defaults(raw)))
    valid = accepted_of(judged)
    append_listings(valid, table_path)
    if csv_path:
        write_csv(valid, csv_path)
    if audit_path:
        append_audit(audit_of(judged), audit_path)


def collect_pages(pages: DataFrame, category: str, table_path: str, audit_path: str | None = None) -> None:
    store_listings(extract_listings(pages, category).drop("page_id"), table_path, audit_path)
