"""Operators of a training-data pipeline: search, dedup, scoring, tokenizers, sharding."""
