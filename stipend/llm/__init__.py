"""Operators for training-data pipelines: deduplication, filters, scores, search and packing."""
