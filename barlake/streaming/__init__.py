"""Structured Streaming queries: topic or files in, tables and sinks out."""
