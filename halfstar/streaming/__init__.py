"""Chunked ingest as a bounded stream."""

from halfstar.streaming.ingest import ingest_files

__all__ = ["ingest_files"]
