"""File-arrival ingest with Structured Streaming (optional delivery form)."""
