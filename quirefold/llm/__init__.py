"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface and a thin ``opN_*`` query on top of it.
"""
