"""Incremental merges over Structured Streaming."""
