"""Training-data operators: quality, deduplication, language, mixing and packing jobs.

Nothing else in the library imports this subpackage.
"""
