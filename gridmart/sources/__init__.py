"""Readers for landed files, the curated fallback table, table sinks."""
