"""Incremental loading of raw batch folders with Structured Streaming."""
