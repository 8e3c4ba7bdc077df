"""Operators for large text corpora: tokenising, deduplication, filtering, mixing, formatting."""
