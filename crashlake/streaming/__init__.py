"""Incremental loading: new feed files picked up by Structured Streaming."""
