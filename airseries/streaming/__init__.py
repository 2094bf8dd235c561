"""Structured Streaming on sensor readings."""
