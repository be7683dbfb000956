"""Structured Streaming ingest of the landing folder."""
