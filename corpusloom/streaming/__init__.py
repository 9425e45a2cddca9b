"""Structured Streaming form of the row-local preparation steps."""
