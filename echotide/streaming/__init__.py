"""Incremental ingest and negativity as Structured Streaming jobs."""
