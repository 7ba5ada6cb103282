"""Structured Streaming jobs over dropped files."""
