"""Streaming queries and their sinks."""
