"""Operators for training-data pipelines: cleaning, deduplication, scoring, encoding and sharding of corpora."""
