"""Training-data operators: quality, PII, dedup, search, extraction, packing.

Nothing else in the library imports this subpackage; it can be deleted whole.
"""
