"""Operators for training-data pipelines: deduplication, packing, search, archives, filters and formats.

Nothing else in the library imports this subpackage.
"""
