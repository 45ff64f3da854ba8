"""Structured Streaming forms of the stateless and incremental jobs."""
