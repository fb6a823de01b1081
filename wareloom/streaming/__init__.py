"""Applying fitted stages to listings that arrive as a stream."""
