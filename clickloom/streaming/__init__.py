"""Structured Streaming: log source and refreshing side table."""
