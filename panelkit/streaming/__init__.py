"""Incremental ingest (SRC-12) on Structured Streaming."""
