"""Incremental page ingest and subscription state."""
