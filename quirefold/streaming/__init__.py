"""Structured Streaming forms of the row-wise operators."""
