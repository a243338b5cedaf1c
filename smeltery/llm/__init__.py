"""Operators on text corpora: deduplication, filtering, scoring, mixing and sharding."""
