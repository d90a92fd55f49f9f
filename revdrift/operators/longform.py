"""Shingling in chunks of tokens, for very large single documents.

The array form keeps a document's whole shingle list in one row, which is
right for ordinary documents.  Here a document's encoded tokens are cut into
chunks of ``chunk_tokens`` window starts, each with the ``w - 1`` tokens behind
it, so that a row never holds more than a chunk's digests.  No token is
shuffled and no window function runs over tokens; a sketch takes the least
digests of each chunk first and only those meet in a shuffle.

Digests are identical to the array form.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.digests import digest_lists
from ..functions.text import encode_tokens, shingle_hashes, tokenize
from .shingle import check_windows


def _chunks(tokens: DataFrame, ws: Sequence[int], keys: Sequence[str], chunk_tokens: int) -> DataFrame:
    """[keys..., _at (window starts before the chunk), _part] of chunks of ``_t``, each
    with the tokens behind it that its windows reach.  Short texts have one chunk, too: a
    filter on their size would go below the exchange and tokenise in the scan's tasks."""
    b = int(chunk_tokens)
    if b <= 0:
        raise ValueError("chunk_tokens must be positive")
    last = F.greatest(F.floor((F.size("_t") - min(ws)) / b), F.lit(0)).cast("int")
    cut = tokens.select(*keys, "_t", F.explode(F.sequence(F.lit(0), last)).alias("_c"))
    at = (F.col("_c") * b).cast("int")
    return cut.select(*keys, at.alias("_at"), F.slice("_t", at + 1, F.lit(max(ws) + b - 1)).alias("_part"))


def shingle_rows(docs: DataFrame, w: int, keys: Sequence[str] = ("page", "version"),
                 text_col: str = "text", chunk_tokens: int = 1 << 16) -> DataFrame:
    """[keys..., pos (1-based window start), shingle]; documents shorter than w give no rows."""
    w, = check_windows([w])
    rows = _chunks(docs.select(*keys, encode_tokens(tokenize(text_col)).alias("_t")), [w], list(keys), chunk_tokens)
    return rows.select(*keys, "_at", F.posexplode(shingle_hashes("_part", w)).alias("_p", "shingle")).select(
        *keys, (F.col("_at") + F.col("_p") + 1).cast("int").alias("pos"), "shingle")


def bottom_k(docs: DataFrame, ws: Iterable[int], k: int, keys: Sequence[str] = ("page", "version"),
             text_col: str = "text", chunk_tokens: int = 1 << 16) -> DataFrame:
    """The k least digests of each document and w (a lambda-sketch, duplicates
    kept) as rows [keys..., w, rank, shingle]: k of each chunk, then k of those."""
    keys, ws = list(keys), check_windows(ws)
    parts = _chunks(docs.select(*keys, tokenize(text_col).alias("_t")), ws, keys, chunk_tokens)
    lists = parts.select(*keys, "_at", F.posexplode_outer(digest_lists("_part", ws=ws, least=int(k), starts=int(chunk_tokens))).alias("_i", "_digests"))
    least = lists.select(*keys, F.get(F.array(*[F.lit(w) for w in ws]), F.col("_i")).alias("w"), "_at",
                         F.posexplode("_digests").alias("_p", "shingle"))
    order = Window.partitionBy(*keys, "w").orderBy("shingle", "_at", "_p")
    ranked = least.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= int(k)).select(*keys, "w", "rank", "shingle")
