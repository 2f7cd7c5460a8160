"""Incremental loads: polled chunks and Structured Streaming."""
