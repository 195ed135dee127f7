"""Incremental release ingest on Structured Streaming's file source."""
