"""Structured Streaming jobs; their logic is shared with the batch jobs."""
