"""Operators for preparing training data: deduplication, filters, counts, mixing.

Nothing else in the package imports this one. ``queries`` registers them.
"""
