"""Structured Streaming jobs: bronze ingestion, dead letters, dedup, monitoring, merges."""
