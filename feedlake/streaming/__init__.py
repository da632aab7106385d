"""Structured Streaming forms of insert and feed state."""
