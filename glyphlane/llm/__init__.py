"""Operators of a training-data pipeline: dedup, search, classifiers, tokens, packing."""
