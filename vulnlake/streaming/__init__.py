"""Structured Streaming: incremental ingestion of document folders into bronze, stateful window counts."""

from .ingest import run_available, start_bronze_stream, stream_documents
from .windows import read_window_counts, start_window_counts, tumbling_counts

__all__ = ["read_window_counts", "run_available", "start_bronze_stream", "start_window_counts", "stream_documents", "tumbling_counts"]
