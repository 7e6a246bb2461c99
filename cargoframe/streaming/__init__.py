"""Incremental (Structured Streaming) form of the labelling jobs."""
