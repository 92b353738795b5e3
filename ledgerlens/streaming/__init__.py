"""Incremental Bronze ingest with Structured Streaming."""

from ledgerlens.streaming.ingest import ingest_csv_stream

__all__ = ["ingest_csv_stream"]
