"""Operators on text corpora: cleaning, filtering, deduplication, mixing, scoring and tokens."""
