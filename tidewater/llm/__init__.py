"""Operators for training-data pipelines: duplicates, quality, mixing, tokens, archives."""
