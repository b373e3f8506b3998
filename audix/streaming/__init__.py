"""Incremental (Structured Streaming) form of the daily evaluation."""
