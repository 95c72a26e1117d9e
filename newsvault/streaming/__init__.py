"""Structured Streaming forms of ingest, vault load and weekly aggregate."""
