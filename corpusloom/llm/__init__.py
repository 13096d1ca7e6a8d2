"""Operators for preparing training data: search, deduplication, scoring, filtering, tokenisation."""
