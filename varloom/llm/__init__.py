"""Operators for training-data pipelines: cleaning, deduplicating, mixing, packing and storing text."""
