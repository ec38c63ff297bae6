"""Incremental (Structured Streaming) form of the bronze ingest."""
