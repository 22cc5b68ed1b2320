"""Operators for training-data pipelines: scoring, archives, deduplication,
tokenisation, packing, filtering and classification of text tables."""
