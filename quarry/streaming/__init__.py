"""Structured Streaming versions of ingestion and run monitoring."""
