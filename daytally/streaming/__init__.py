"""Structured Streaming queries: collecting logs, daily devices, order changes."""
