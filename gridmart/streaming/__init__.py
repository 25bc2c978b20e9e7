"""Incremental landing of newly arrived files with Structured Streaming."""
