"""Structured Streaming jobs, one per warehouse layer."""
