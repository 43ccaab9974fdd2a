"""Structured Streaming versions of the change feeds."""
