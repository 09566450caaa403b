"""Operators for training-data pipelines: filters, deduplication, tokenizing, scoring and packing of documents."""
