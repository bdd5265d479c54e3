"""Whole pipelines: verification of two editions, layout findings, and the registered queries."""
