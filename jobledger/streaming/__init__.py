"""Structured Streaming forms of following a job."""
