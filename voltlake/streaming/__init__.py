"""Structured Streaming versions of ingest, deduplication and daily usage."""
