"""Incremental ingest with Structured Streaming (the chunked ingest, re-aimed)."""
