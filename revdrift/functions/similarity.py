"""Set-similarity expressions over sketch arrays.

Jaccard compares sketch with sketch: ``|A ∩ B| / |A ∪ B|`` of the *sets* of the
two (already truncated) multisets.  Both empty -> 1.0, one empty -> 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def intersection_size(a, b) -> Column:
    return F.size(F.array_intersect(_col(a), _col(b)))


def union_size(a, b) -> Column:
    return F.size(F.array_union(_col(a), _col(b)))


def jaccard_from_sizes(inter, union) -> Column:
    inter, union = _col(inter), _col(union)
    # ANSI mode raises on 0/0, so the empty/empty case is decided first.
    return F.when(union == 0, F.lit(1.0)).otherwise(
        inter.cast("double") / union.cast("double"))


def jaccard(a, b) -> Column:
    return jaccard_from_sizes(intersection_size(a, b), union_size(a, b))


def micro_units(j) -> Column:
    """A 6-decimal value as an exact integer count of 1e-6 units."""
    return F.round(_col(j) * F.lit(1_000_000)).cast("long")
