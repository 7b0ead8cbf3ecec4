"""Incremental loads over Structured Streaming."""
