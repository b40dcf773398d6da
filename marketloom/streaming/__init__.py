"""Micro-batch ingestion of listings."""
