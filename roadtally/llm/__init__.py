"""Operators for training-data pipelines: deduplication, mixing, search, screening, output."""
