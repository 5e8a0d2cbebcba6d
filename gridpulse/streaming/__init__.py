"""Structured Streaming forms of the rollup and of replay-safe ingest."""
