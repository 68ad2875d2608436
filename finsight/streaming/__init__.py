"""Incremental (file-triggered) loads as Structured Streaming jobs."""
