"""Incremental file arrival with Structured Streaming."""

from strata.streaming.arrival import ingest_available, ingest_csv_available

__all__ = ["ingest_available", "ingest_csv_available"]
