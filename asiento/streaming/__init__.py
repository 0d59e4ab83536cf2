"""Posting calls that arrive as a stream."""
