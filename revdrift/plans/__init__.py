"""Composite jobs, derived corpora and the query registry."""
