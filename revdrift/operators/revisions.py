"""Revision logs: offsets, every-k-th sampling, catalogs, ordered concatenation.

A revision log is [page, revid, timestamp, ...], newest first by
(timestamp desc, revid desc).  The offset of a revision is its 0-based rank
counted back from the current one.  Sampling keeps offsets 0, step, 2*step,
... up to ``max_back``; the filter is on the *raw* ``row_number`` so Catalyst
adds a per-partition ``WindowGroupLimit`` below the shuffle, and a page with a
third of all revisions ships at most ``max_back + 1`` rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .compare import is_target
from .ranking import rank_within

SEPARATOR = "\n" + "=" * 80 + "\n\n"
# trailing Unicode whitespace (Python rstrip) at the very end of the text
_TRAILING_WS = ("[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}"
                "\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+\\z")


def revision_offsets(revs: DataFrame, max_count: int | None = None, page: str = "page") -> DataFrame:
    """Add ``offset`` (0 = current revision); keep at most ``max_count`` per page.

    With ``max_count`` the rank is a window whose filter becomes a
    ``WindowGroupLimit`` (bounded per page); without it the whole history is
    numbered by the skew-safe ``rank_within``.
    """
    if max_count is None:
        return rank_within(revs, page, ["timestamp", "revid"], out="offset", descending=True)
    w = Window.partitionBy(page).orderBy(F.desc("timestamp"), F.desc("revid"))
    ranked = revs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= int(max_count))
    return ranked.withColumn("offset", (F.col("_rn") - 1).cast("int")).drop("_rn")


def sample_revisions(revs: DataFrame, step: int = 3, max_back: int = 147, page: str = "page") -> DataFrame:
    """Every ``step``-th revision from the current one back to ``max_back``."""
    if step <= 0 or max_back < 0:
        raise ValueError("step must be positive and max_back non-negative")
    off = revision_offsets(revs, max_count=max_back + 1, page=page)
    return off.filter(F.col("offset") % step == 0)


def catalog(versions: DataFrame, page: str = "page") -> DataFrame:
    """Distinct (page, version) pairs, long form (no per-page arrays)."""
    return versions.select(page, "version").distinct()


def catalog_summary(versions: DataFrame, page: str = "page") -> DataFrame:
    """[page, n_versions, min_version, max_version, n_targets, has_baseline]."""
    cat = catalog(versions, page)
    return cat.groupBy(page).agg(
        F.count("version").alias("n_versions"),
        F.min("version").alias("min_version"),
        F.max("version").alias("max_version"),
        F.count(F.when(is_target("version"), 1)).alias("n_targets"),
        F.max(F.col("version") == 0).alias("has_baseline"),
    )


def page_listing(versions: DataFrame, page: str = "page") -> DataFrame:
    return versions.select(page).distinct().orderBy(page)


def concat_versions(versions: DataFrame, page: str = "page", text_col: str = "text") -> DataFrame:
    """One text per page: each version's text followed by the separator line,
    in version order, right-stripped, one final newline.

    Call it on sampled versions (bounded per page, as the reference does);
    an unbounded version history would make one row per page unbounded
    (``concat_parts`` is the form for those).
    """
    parts = versions.select(page, "version", F.concat(F.coalesce(text_col, F.lit("")), F.lit(SEPARATOR)).alias("_p"))
    agg = parts.groupBy(page).agg(
        F.count("*").alias("n_parts"),
        F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("version", "_p"))), lambda s: s["_p"]), "").alias("_raw"))
    return agg.select(page, "n_parts",
                      F.concat(F.regexp_replace("_raw", _TRAILING_WS, ""), F.lit("\n")).alias("text"))


def concat_parts(versions: DataFrame, page: str = "page", text_col: str = "text", versions_per_part: int = 64) -> DataFrame:
    """[page, part_no, rank, line]: the lines that, written one behind the other
    with a line feed behind each, are ``concat_versions`` of a page.

    A part is ``versions_per_part`` versions, so a page of any length is as many
    rows as it has versions and is dealt to a task a part; ranks are those of
    ``rank_within``, so a hot page is not sorted by one task.  As the separator
    ends in a sign that is no white space, a page's end is its last separator
    whatever its texts are.  Null texts count as empty, null versions come first,
    texts of one version follow one another in the order of their hash.  A page
    without a name is an error when the lines are read.
    """
    if versions_per_part <= 0:
        raise ValueError("versions_per_part must be positive")
    rows = versions.select(page, "version", F.coalesce(text_col, F.lit("")).alias("_p")).withColumn("_tie", F.xxhash64("_p"))
    ranked = rank_within(rows, page, ["version", "_tie"], out="rank")
    behind = SEPARATOR.removesuffix("\n\n")  # its line feeds are the line's own and the next one's first
    line = F.concat(F.when(F.col("rank") > 0, F.lit("\n")).otherwise(F.lit("")), F.col("_p"), F.lit(behind))
    unnamed = F.col(page).isNull() | (F.col(page) == "")
    return ranked.select(page, F.floor(F.col("rank") / int(versions_per_part)).cast("int").alias("part_no"), "rank",
                         F.when(unnamed, F.raise_error("a page without a name").cast("string")).otherwise(line).alias("line"))


def split_page_key(key, sep: str = "_"):
    """(city, state) from 'City_ST'; NULLs unless the key splits into exactly two."""
    parts = F.split(F.col(key) if isinstance(key, str) else key, sep)
    ok = F.size(parts) == 2
    return (F.when(ok, parts[0]).alias("city"), F.when(ok, parts[1]).alias("state"))
