"""Document fingerprints by threshold-scaled sketches, in DataFrame functions.

A fingerprint holds every hash of a document's distinct five-word shingles that
lies below a fixed fraction of the hashes' range.  Long documents keep more of
them, so the share of one document's hashes that another holds estimates how
much of it the other contains whatever their lengths; and the fingerprint of
documents taken together is the union of theirs.

The least hash is kept wherever it lies: a text with words has a fingerprint,
and equal short texts are seen to be equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions

SHINGLE = 5
#: Hexadecimal digits of a hash, and the first that is not kept: a quarter of the range.
DIGITS, LIMIT = 12, "4"
#: Stretches of ids for each task, and rows a stretch that set their bounds.
STRETCHES, SAMPLED = 4, 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words.
GAPS = r"[\x20\x09-\x0D]+"


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(words: Column) -> Column:
    """Hashes of the shingles of a non-empty array of words; fewer words are one shingle."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0))),
        lambda i: F.substring(F.md5(F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE)]).cast("binary")), 1, DIGITS))


def fingerprint(text: Column, limit: str = LIMIT) -> Column:
    """The kept hashes of a text, rising, without repeats; none for null, empty and wordless texts."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    kept = lambda all_: F.array_union(F.filter(all_, lambda h: h < limit), F.array(F.array_min(all_)))
    of = lambda w: F.when(F.size(w) > 0, F.sort_array(_with(_hashes(w), kept))).otherwise(F.array().cast("array<string>"))
    return _with(F.filter(F.split(lower, GAPS), lambda w: w != ""), of)


def containment(one: Column, other: Column) -> Column:
    """The share of ``one``'s hashes that ``other`` holds; 1 if both have none, 0 if only ``one`` has none."""
    share = F.size(F.array_intersect(one, other)) / F.size(one).cast("double")
    return F.when(F.size(one) > 0, share).otherwise(F.when(F.size(other) > 0, 0.0).otherwise(1.0))


def merged(fingerprints: DataFrame, by: str, fingerprint_col: str = "fingerprint") -> DataFrame:
    """[by, hash]: the fingerprints of groups of documents, a row for each hash.

    Null groups are one group.  The least hashes above the fraction stay in, as they came."""
    return fingerprints.select(by, F.explode(fingerprint_col).alias("hash")).distinct()


def contained(fingerprints: DataFrame, groups: DataFrame, by: str, id_col: str = "doc_id",
              fingerprint_col: str = "fingerprint") -> DataFrame:
    """[id, by, containment]: how much of each document the merged groups [by, hash]
    hold, for the groups that hold any.  Rows of one id count together."""
    rows = fingerprints.select(F.col(id_col), F.explode(fingerprint_col).alias("hash")).distinct()
    size = rows.groupBy(id_col).agg(F.count("*").alias("n"))
    held = rows.join(groups.select(by, "hash"), "hash").groupBy(id_col, by).agg(F.count("*").alias("held"))
    return held.join(size, id_col).select(id_col, by, (F.col("held") / F.col("n").cast("double")).alias("containment"))


def _bounds(rows: DataFrame, stretches: int) -> list[int]:
    """Ids, falling, that part the rows into stretches of about as many rows each."""
    every = max(1, rows.count() // (SAMPLED * stretches))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    shares = [k / stretches for k in range(1, stretches)]
    found = sample.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 4 * stretches)).first()[0] if shares else None
    return sorted(set(found or []), reverse=True)


def _stretch(id_: Column, bounds: list[int]) -> Column:
    """The number of bounds above an id, sought in groups of bounds first; null ids lie behind all."""
    each = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k:k + each] for k in range(0, len(bounds), each)]
    if not groups:
        return F.lit(0)
    above = lambda array: F.size(F.filter(array, lambda b: b > id_))
    lists = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
    full = above(F.array(*[F.lit(g[-1]) for g in groups]))  # groups that lie above the id with all their bounds
    rest = F.coalesce(above(F.get(lists, full)), F.lit(0))
    return F.when(id_.isNull(), len(bounds)).otherwise(F.least(full * each, F.lit(len(bounds))) + F.when(full < len(groups), rest).otherwise(0))


def with_next(rows: DataFrame, *carried: str) -> DataFrame:
    """``rows`` [doc_id, ...] with ``next_<column>`` for each carried column: that of
    the next row by falling id, of the first row behind the last.

    Null ids come last; rows of one id are in the order of the carried columns.
    The ids are cut into stretches at bounds that are literals in the plan; each
    stretch is sorted by itself and also gets the first row of the one behind
    it, so texts are shuffled once.  The driver gets two ids for each stretch.
    """
    bounds = _bounds(rows.select("doc_id"), STRETCHES * partitions(rows.sparkSession))
    dealt = rows.withColumn("__stretch", _stretch(F.col("doc_id"), bounds))
    first = {r[0]: r[1] for r in dealt.groupBy("__stretch").agg(F.max("doc_id")).collect()}
    full = sorted(first)
    ahead = dict(zip(full, full[-1:] + full[:-1]))
    heads, before = ([of.get(k) for k in range(len(bounds) + 1)] for of in (first, ahead))
    literal = lambda values, kind: F.array(*[F.lit(v).cast(kind) for v in values])
    is_head = F.col("doc_id").eqNullSafe(F.get(literal(heads, "long"), F.col("__stretch")))
    own = F.struct(F.col("__stretch").alias("stretch"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(literal(before, "int"), F.col("__stretch")).alias("stretch"), F.lit(True).alias("guest"))
    both = dealt.withColumn("__at", F.explode(F.when(is_head, F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("__at.stretch").orderBy("__at.guest", F.col("doc_id").desc_nulls_last(), *carried)
    return (both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
            .filter(~F.col("__at.guest")).drop("__at", "__stretch"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: str = LIMIT) -> DataFrame:
    """One row for each row of ``docs``: [doc_id, text, fingerprint].

    Words are parted by ASCII white space and lower-cased in A to Z.  Null texts
    are returned as empty ones; they, empty and wordless texts have no hashes.
    Very long texts are worked off whole, a row at a time.  Repeated rows are
    worked off one by one, null ids stay null, other columns are ignored, and an
    empty table gives no rows.  Narrow; ``limit`` is the first hash (or its first
    digits) that is not kept.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), fingerprint(text, limit).alias("fingerprint"))
