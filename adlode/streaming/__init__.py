"""Incremental ingest and trends on Structured Streaming."""
