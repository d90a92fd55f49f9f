"""Incremental shingling of newly landed dump files (Structured Streaming)."""
