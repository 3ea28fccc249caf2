"""Structured Streaming ingest of trip messages."""
