"""Structured Streaming versions of the snapshot, correlation and alert jobs."""
