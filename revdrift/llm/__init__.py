"""Operators for preparing training corpora: deduplication, scoring, tokens, packing."""
