"""Sets of versions as bits: similarity without arrays of digests.

A page has at most ``max_back // step`` targets and a baseline, so the versions
that hold a shingle fit the bits of one long.  ``version_masks`` turns texts into
rows (page, w, digest, mask) by ``bit_or``; sizes, intersections and unions are
then sums over masks.  No row holds a list of digests, so a document of millions
of tokens needs no more memory than a chunk of it, and no digest is joined.

The versions of a page differ little, so chunks are dealt by (page, number of
the chunk) first and the versions of a chunk meet in one task.  Windows that lie
in the tokens that a version shares with the first one there, at the start or at
the end of the chunk, are hashed once, with the bits of all versions that hold
them; of the other versions only the windows between are.  Partial aggregation
then leaves about one row for each digest however many versions hold it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import jaccard_from_sizes
from ..functions.text import encode_tokens, let, shingle_hashes, tokenize
from ..session import work_partitions
from .compare import MAX_BACK, STEP, bit, has_bit, is_target, needed_versions
from .shingle import check_windows


def version_bit(version: Column | str = "version", step: int = STEP, max_back: int = MAX_BACK) -> Column:
    """A long with the bit of a baseline (the lowest) or target version set."""
    if step <= 0 or max_back // step > 62:
        raise ValueError("a page may have 62 targets at most")
    v = F.col(version) if isinstance(version, str) else version
    return bit((v / step).cast("int"))


def one_text_a_version(versions: DataFrame, page: str = "page", text_col: str = "text") -> DataFrame:
    """``versions`` without further texts of a version that is there with several: the
    one of the least hash stays.  Only keys and hashes are aggregated; the join
    brings the few versions that have two different texts, if any."""
    tie = F.xxhash64(text_col)
    several = (versions.groupBy(page, "version").agg(F.min(tie).alias("_least"), F.max(tie).alias("_most"))
               .filter("_least != _most").select(page, "version", "_least"))
    return (versions.join(several, [page, "version"], "left")
            .filter(F.col("_least").isNull() | (F.col("_least") == tie)).drop("_least"))


def version_masks(versions: DataFrame, ws: Iterable[int], step: int = STEP, max_back: int = MAX_BACK, page: str = "page",
                  text_col: str = "text", chunk_tokens: int = 1 << 16, unique: bool = False) -> DataFrame:
    """[page, w, digest (binary), mask]: which baseline and target versions hold a shingle.

    Versions without a shingle of some w have their bits in a row with a null
    digest.  Null texts count as empty, rows with a null page make a page of
    their own, other versions (negative ones too) and columns are ignored, an
    empty table gives no rows.  Repeated rows change nothing; of a version with several texts that of
    the least hash counts, unless ``unique`` says that there are none.
    """
    b = int(chunk_tokens)
    if b <= 0:
        raise ValueError("chunk_tokens must be positive")
    needed = versions.filter(needed_versions("version", step, max_back) & (F.col("version") >= 0)).select(page, "version", text_col)
    if not unique:
        needed = one_text_a_version(needed, page, text_col)
    widths = check_windows(ws)
    most = max(widths)
    cut = needed.select(page, version_bit("version", step, max_back).alias("_own"), tokenize(text_col).alias("_t"))
    # a chunk holds the window starts of its tokens for every w, so it has most - 1 tokens behind it
    last = F.greatest(F.floor((F.size("_t") - min(widths)) / b), F.lit(0)).cast("int")
    cut = cut.select(page, "_own", "_t", F.explode(F.sequence(F.lit(0), last)).alias("_c"))
    # dealt as text, which is shorter than a list; no token has a space
    parts = cut.select(page, "_own", "_c", F.concat_ws(" ", F.slice("_t", F.col("_c") * b + 1, b + most - 1)).alias("_part"))
    dealt = parts.repartition(work_partitions(versions.sparkSession), page, "_c").withColumn("_part", F.array_remove(F.split("_part", " "), ""))
    sized = _with_stretches(dealt, widths, b, page)
    # each w by itself: windows of a known size are joined from few parts
    own = F.coalesce(*[F.when(F.col("w") == w, shingle_hashes(F.slice("_e", F.col("_from") + 1, F.col("_to") - F.col("_from") + (w - 1)), w))
                       for w in widths])
    rows = sized.select(page, "w", "_bit", F.explode_outer(own).alias("_d"))
    return rows.groupBy(page, "w", F.unhex("_d").alias("digest")).agg(F.bit_or("_bit").alias("mask"))


def _same_start(a: Column, b: Column) -> Column:
    """How many leading tokens two lists share."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return (F.array_position(F.concat(same, F.array(F.lit(False))), F.lit(False)) - 1).cast("int")


def _with_stretches(parts: DataFrame, widths: Sequence[int], b: int, page: str) -> DataFrame:
    """[page, w, _e, _from, _to, _bit]: the window starts of the encoded tokens ``_e`` that are
    to be hashed, and the versions that hold these windows.

    The first version of a chunk has all its windows, in stretches that the same
    versions share; another one has those that are not in the first.  A version
    without windows has an empty stretch."""
    most, along = max(widths), Window.partitionBy(page, "_c")
    first = parts.withColumns({"_ref": F.first("_part").over(along.orderBy("_own")), "_is_ref": F.row_number().over(along.orderBy("_own")) == 1})
    shared = first.select(
        page, "_c", "_own", "_is_ref", "_part", F.size("_part").alias("_n"), F.size("_ref").alias("_m"),
        F.when(F.col("_is_ref"), F.size("_part")).otherwise(_same_start(F.col("_ref"), F.col("_part"))).alias("_head"),
        F.when(F.col("_is_ref"), F.size("_part")).otherwise(_same_start(F.reverse("_ref"), F.reverse("_part"))).alias("_tail"))
    # the first one's windows behind the chunk's last start are the next chunk's: longer ends are kept whole
    whole = (F.col("_m") > F.col("_n")) & (F.col("_m") >= b + min(widths))
    at = F.when(F.col("_is_ref"), 0).otherwise(F.greatest(F.col("_head") - (most - 1), F.lit(0)))
    end = F.when(F.col("_is_ref") | whole, F.col("_n")).otherwise(F.col("_n") - F.col("_tail") + (most - 1))
    kept = shared.withColumn("_at", at).select(
        page, "_c", "_own", "_is_ref", "_n", "_m", "_head", "_tail", "_at", F.slice("_part", F.col("_at") + 1, F.greatest(end - F.col("_at"), F.lit(0))).alias("_part"))
    # a set: repeated rows of a version count once
    others = F.collect_set(F.struct("_own", "_head", "_tail")).over(along)
    kept = kept.withColumn("_others", F.when(F.col("_is_ref"), others))

    def clamped(place: Column, w: int) -> Column:
        return F.greatest(F.least(place, _starts(w)), F.lit(0))

    def _starts(w: int) -> Column:
        return F.least(F.col("_n") - (w - 1), F.lit(b))

    def stretch(w: int, start: Column, stop: Column, mask: Column) -> Column:
        return F.struct(F.lit(w).alias("w"), (start - F.col("_at")).alias("_from"), (stop - F.col("_at")).alias("_to"), mask.alias("_bit"))

    def of_first(w: int) -> Column:
        def ends(o: Column) -> Column:
            return F.array(clamped(o["_head"] - (w - 1), w), clamped(F.col("_m") - o["_tail"], w))
        edges = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), _starts(w)), F.flatten(F.transform("_others", ends)))))

        def held(start: Column) -> Column:
            return F.aggregate("_others", F.lit(0).cast("long"), lambda mask, o: F.when(
                (start <= o["_head"] - w) | (start >= F.col("_m") - o["_tail"]), mask.bitwiseOR(o["_own"])).otherwise(mask))
        return let(edges, lambda e: F.transform(F.slice(e, 1, F.size(e) - 1), lambda start, i: stretch(
            w, start, F.get(e, i + 1), held(start).bitwiseOR(F.col("_own")))))

    def of_other(w: int) -> Column:
        start, stop = clamped(F.col("_head") - (w - 1), w), clamped(F.col("_n") - F.col("_tail"), w)
        late = F.greatest(start, stop, F.lit(b) - F.col("_m") + F.col("_n"))
        return F.filter(F.array(stretch(w, start, stop, F.col("_own")), stretch(w, late, _starts(w), F.col("_own"))),
                        lambda s: s["_to"] > s["_from"])

    def of(w: int) -> Column:
        nothing = F.array(stretch(w, F.col("_at"), F.col("_at"), F.col("_own")))
        return F.when(_starts(w) <= 0, nothing).when(F.col("_is_ref"), of_first(w)).otherwise(of_other(w))
    # encoded below the generator, once for all stretches
    return kept.withColumn("_e", encode_tokens("_part")).select(page, "_e", F.inline(F.concat(*[of(w) for w in widths])))


def _counted(masks: DataFrame, page: str) -> DataFrame:
    """[page, w, mask, n]: digests of each set of versions (few sets a page)."""
    return masks.groupBy(page, "w", "mask").agg(F.count("digest").alias("n"))


def jaccard_from_masks(masks: DataFrame, step: int = STEP, max_back: int = MAX_BACK, page: str = "page") -> DataFrame:
    """[page, w, version, intersection, union_size, jaccard] of each target with version 0 over all shingles.

    A page has few different masks beside its digests, so all behind the first
    aggregation is small; pages without version 0 give no rows."""
    grid = F.array(*[F.lit(v) for v in range(0, max_back + 1, step)])
    held = _counted(masks, page).select(
        page, "w", "n", has_bit(F.col("mask"), bit(F.lit(0))).alias("_base"),
        F.explode(F.filter(grid, lambda v: has_bit(F.col("mask"), bit((v / step).cast("int"))))).alias("version"))
    sizes = held.groupBy(page, "w", "version").agg(
        F.sum("n").alias("_own"), F.sum(F.when(F.col("_base"), F.col("n")).otherwise(0)).alias("intersection"))
    base = F.max(F.when(F.col("version") == 0, F.col("_own"))).over(Window.partitionBy(page, "w"))  # at most 63 rows each
    both = sizes.withColumn("_of_base", base).filter(F.col("_of_base").isNotNull() & is_target("version", step, max_back))
    union = F.col("_of_base") + F.col("_own") - F.col("intersection")
    return both.select(page, "w", "version", F.col("intersection").cast("int"), union.cast("int").alias("union_size")).select(
        "*", jaccard_from_sizes("intersection", "union_size").alias("jaccard"))


def set_members(masks: DataFrame, versions: Sequence[int], how: str, step: int = STEP, page: str = "page") -> DataFrame:
    """[page, w, digest]: the shingles that ``all`` (intersection) or ``any`` (union) of the versions hold."""
    if how not in ("all", "any"):
        raise ValueError("how is 'all' or 'any'")
    if not versions:
        raise ValueError("no versions")
    wanted = F.lit(sum({1 << (v // step) for v in versions})).cast("long")
    common = F.col("mask").bitwiseAND(wanted)
    return masks.filter((common == wanted if how == "all" else common != 0) & F.col("digest").isNotNull()).select(page, "w", "digest")


def set_sizes(masks: DataFrame, page: str = "page") -> DataFrame:
    """[page, w, n_versions, n_shared, n_union]: the shingles that all versions of a page hold, and any."""
    every = _counted(masks, page).withColumn("_all", F.bit_or("mask").over(Window.partitionBy(page, "w")))
    shared = F.when(F.col("mask") == F.col("_all"), F.col("n")).otherwise(0)
    return every.groupBy(page, "w").agg(F.bit_count(F.max("_all")).cast("int").alias("n_versions"),
                                        F.sum(shared).alias("n_shared"), F.sum("n").alias("n_union"))
