"""Operators of a training-data pipeline: parsing, filtering, deduplication, tokenizing."""
