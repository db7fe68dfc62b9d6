"""Operators for preparing text corpora: extraction, filtering, near-duplicates, mixing, tokens and search."""
