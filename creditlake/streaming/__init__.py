"""Incremental loads and Structured Streaming jobs."""
