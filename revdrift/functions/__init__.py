"""Column-level expressions (tokens, shingles, sketches, similarity, labels)."""

from .text import (INF_K, WHITESPACE_RUN, encode_tokens, shingle_hashes,
                   shingles, sketch, tokenize)
from .similarity import (intersection_size, jaccard, jaccard_from_sizes,
                         micro_units, union_size)
from .labels import (INF_LABEL, lambda_display, lambda_k, lambda_label,
                     lambda_order, safe_name, safe_path_token)

__all__ = [
    "INF_K", "INF_LABEL", "WHITESPACE_RUN", "encode_tokens", "intersection_size",
    "jaccard", "jaccard_from_sizes", "lambda_display", "lambda_k", "lambda_label",
    "lambda_order", "micro_units", "safe_name", "safe_path_token",
    "shingle_hashes", "shingles", "sketch", "tokenize", "union_size",
]
