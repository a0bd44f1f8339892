"""Training-data operators: dedup, filters, extraction, tokenising and search.

Nothing else in the package imports this subpackage.
"""
