"""Operators for training-data pipelines: deduplication, filters, tokens, packing, archives, classifiers."""
