"""Structured Streaming: bronze ingest, keyed dedup, compaction."""
