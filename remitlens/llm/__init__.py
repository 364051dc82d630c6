"""Operators for training-data pipelines: deduplication, packing, tokenizing, formatting, scoring and filters."""
