"""Structured Streaming ingest (watermarked dedup + idempotent upsert sink)."""
