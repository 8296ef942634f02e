"""Structured Streaming forms of ingestion, merge, history and quarantine."""
