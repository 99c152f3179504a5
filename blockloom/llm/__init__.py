"""Operators for large text corpora: classification, cleaning, deduplication, search and packing."""
