"""Operators for large text corpora: deduplication, filtering, scoring, tokenising and formatting."""
