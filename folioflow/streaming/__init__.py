"""The ingest stages as Structured Streaming queries."""
