"""Incremental retail warehouse on Spark: ingestion, history, star schema, checks, reports."""
