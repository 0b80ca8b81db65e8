"""Structured Streaming ingest of landed article refs."""
