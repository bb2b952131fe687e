"""Incremental ingest of landed raw snapshots (Structured Streaming)."""

from .landing import ingest_landed_series, landed_files_stream  # noqa: F401
