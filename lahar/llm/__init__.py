"""Operators for training-data corpora: dedup, scoring, tokens, mixing, media, neighbours."""
