"""Structured Streaming jobs (STR-1..6)."""
