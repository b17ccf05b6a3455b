"""Bounded file-stream ingest with an operations log."""
