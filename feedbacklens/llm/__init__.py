"""Operators of a training-data pipeline: filters, deduplication, search, tokens, mixing."""
