"""Shingling operators (one narrow stage, no shuffle).

``shingle`` takes the sorted MD5 multisets of all requested window sizes of a text
from one Arrow UDF (``functions.pairs.text_lists``) and fans the row out over them.

``sketch`` derives every lambda from the one sorted multiset by truncation
(compute once, derive many): the lambda grid is a literal array ``inline``d on
the row, so there is no join at all and the MD5 work is not repeated.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import INF_LABEL
from ..functions.pairs import text_lists
from ..functions.text import INF_K, sketch as _sketch


def check_windows(ws: Iterable[int]) -> list[int]:
    ws = [int(w) for w in ws]
    if not ws or any(w <= 0 for w in ws):
        raise ValueError("w must be positive")
    return ws


def parse_lambdas(lambdas: Iterable) -> list[tuple[str, int]]:
    """Normalise lambda values to (label, k); reject k <= 0 and junk."""
    out: list[tuple[str, int]] = []
    for lam in lambdas:
        s = str(lam).strip()
        if s.lower() in ("inf", "infty", "infinite") or lam == float("inf"):
            out.append((INF_LABEL, INF_K))
            continue
        k = int(s)
        if k <= 0:
            raise ValueError("lambda must be a positive integer or 'inf'")
        out.append((str(k), k))
    if not out:
        raise ValueError("at least one lambda is required")
    return out


def lambda_grid_column(lambdas: Sequence) -> Column:
    """A literal array<struct<lambda string, k int>> for ``inline``."""
    return F.array(*[
        F.struct(F.lit(label).alias("lambda"), F.lit(k).alias("k"))
        for label, k in parse_lambdas(lambdas)
    ])


def shingle(docs: DataFrame, ws: Iterable[int], keys: Sequence[str] = ("page", "version"),
            text_col: str = "text", partition_by: Sequence[str] | None = None,
            partitions: int | None = None, least: int | None = None, repeats: bool = False) -> DataFrame:
    """keys + w, n_tokens, shingles (sorted MD5 multiset, duplicates kept).

    Narrow by default (parallelism comes from the input splits).  With
    ``partition_by`` the *texts* are hash-partitioned first (``partitions``
    explicit, so AQE does not fold the hash-heavy stage into a few tasks);
    partitioning by page also co-locates all versions for a later self-join.
    With ``least`` a list holds its so many least digests: sketches of at most
    that size are taken from it, and no longer list is moved.  With ``repeats``
    there is a column of the places (from 1) of shingles that are those before
    them (``n_distinct`` counts by it).
    """
    ws, keys = check_windows(ws), list(keys)
    if partition_by:
        cols = [F.col(c) for c in partition_by]
        docs = docs.repartition(partitions, *cols) if partitions else docs.repartition(*cols)
    lists = _lists(docs, ws, keys, text_col, least)
    more = [F.get("_repeats", F.col("_i")).alias("repeats")] if repeats else []
    # outer: else a filter on the lists is put below the exchange, and they are made twice
    return lists.select(*keys, "n_tokens", *(["_repeats"] if repeats else []), F.posexplode_outer("_lists").alias("_i", "shingles")).select(
        *keys, F.get(_array(ws), F.col("_i")).alias("w"), "n_tokens", "shingles", *more)


def n_distinct(sketch_: Column | str, repeats: Column | str) -> Column:
    """How many different shingles a sketch holds, by the places of repeated ones in its whole list."""
    n = F.size(sketch_)
    return n - F.size(F.filter(repeats, lambda place: place <= n))


def _array(ws: Sequence[int]) -> Column:
    return F.array(*[F.lit(w) for w in ws])


def _lists(docs: DataFrame, ws: Sequence[int], keys: Sequence[str], text_col: str, least: int | None = None) -> DataFrame:
    """keys + n_tokens, ``_lists`` (a sorted list for each window size) and ``_repeats``."""
    lower = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(*keys, text_lists(lower, ws, least).alias("_made")).select(
        *keys, F.coalesce("_made.n_tokens", F.lit(0)).alias("n_tokens"), F.col("_made.lists").alias("_lists"), F.col("_made.repeats").alias("_repeats"))


def shingle_sets(docs: DataFrame, ws: Iterable[int], keys: Sequence[str] = ("page", "version"),
                 text_col: str = "text") -> DataFrame:
    """keys + n_tokens + ``sets``: array<struct<w int, shingles array<string>>>,
    one entry per window size, all in the row of their text (no fan-out, so
    the row keeps its input partitioning for a later join on the key)."""
    ws, keys = check_windows(ws), list(keys)
    return _lists(docs, ws, keys, text_col).select(*keys, "n_tokens", F.zip_with(
        _array(ws), "_lists", lambda w, s: F.struct(w.alias("w"), s.alias("shingles"))).alias("sets"))


def sketch(shingles: DataFrame, lambdas: Sequence, keep_shingles: bool = False) -> DataFrame:
    """One row per input row and lambda: ``sketch = slice(shingles, 1, k)``."""
    cols = [c for c in shingles.columns if c != "shingles" or keep_shingles]
    return shingles.select(
        *cols, F.inline(lambda_grid_column(lambdas)), F.col("shingles").alias("_s")
    ).select(*cols, "lambda", "k", _sketch("_s", F.col("k")).alias("sketch"))
