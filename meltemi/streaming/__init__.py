"""Structured Streaming twins of the daily batch."""
