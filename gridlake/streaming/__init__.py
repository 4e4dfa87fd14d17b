"""Structured Streaming versions of ingest, cleaning and aggregation."""
