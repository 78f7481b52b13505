"""Incremental ingest of landed raw files with Structured Streaming."""
