"""Structured Streaming entry points (incremental mask ingestion)."""
