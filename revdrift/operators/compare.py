"""Baseline-to-version similarity and the catalog checks around it.

Semantics: for every page that has version 0, compare version 0 with each
*target* version ``v`` (``v % step == 0``, ``v != 0``, ``v <= max_back``) for
every (w, lambda).  Pages without version 0, and pages without any target, are
skipped and reported.  A version that is there twice counts once.

Plan shape: one scan and one exchange.  Rows are dealt by page and sorted by
version, so the baseline comes first and a window carries it along its page;
there is no self-join.  The (w, lambda) grid is a literal that is worked off
inside the row: arrays are never copied once per lambda, and a union's size
follows from the two sizes and the intersection.  A page has at most
``max_back // step`` targets, so a page holding a third of all versions cannot
make one task unbounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import lambda_k
from ..functions.pairs import shared_sizes
from ..functions.similarity import intersection_size, jaccard_from_sizes, union_size
from ..functions.text import sketch as _sketch
from ..session import work_partitions
from .shingle import check_windows, lambda_grid_column, parse_lambdas

STEP = 3
MAX_BACK = 147
#: Versions of a bucket of a completeness mask.
BITS = 64


def is_target(version: Column | str = "version", step: int = STEP, max_back: int = MAX_BACK) -> Column:
    v = F.col(version) if isinstance(version, str) else version
    return ((v % F.lit(step)) == 0) & (v != 0) & (v <= F.lit(max_back))


def needed_versions(version: Column | str = "version", step: int = STEP,
                    max_back: int = MAX_BACK) -> Column:
    """Baseline or target: the only versions a comparison reads."""
    v = F.col(version) if isinstance(version, str) else version
    return (v == 0) | is_target(v, step, max_back)


def _with_baseline(rows: DataFrame, value: str, keys: Sequence[str], step: int, max_back: int) -> DataFrame:
    """Target rows with ``_base``, the value of version 0 of the same ``keys``."""
    along = Window.partitionBy(*keys).orderBy("version", "_tie")
    carried = rows.withColumns({
        "_base": F.first(F.when(F.col("version") == 0, F.col(value)), ignorenulls=True).over(along),
        "_before": F.lag("version").over(along)})
    once = F.col("_before").isNull() | (F.col("_before") != F.col("version"))
    return carried.filter(once & is_target("version", step, max_back) & F.col("_base").isNotNull())


def _sizes(shingles: Column, grid: Column) -> Column:
    """How many distinct shingles each lambda of the grid leaves."""
    return F.transform(grid, lambda g: F.size(F.array_distinct(_sketch(shingles, g["k"]))))


def _cells(base: Column, cur: Column, grid: Column) -> Column:
    """[w, lambda, k, intersection, union_size] of two structs [w, shingles, sizes]."""
    def cell(g, i):
        shared = intersection_size(_sketch(base["shingles"], g["k"]), _sketch(cur["shingles"], g["k"]))
        return F.struct(cur["w"].alias("w"), g["lambda"].alias("lambda"), g["k"].alias("k"), shared.alias("intersection"),
                        (F.get(base["sizes"], i) + F.get(cur["sizes"], i) - shared).alias("union_size"))
    return F.transform(grid, cell)


def _finish(cells: DataFrame, page: str) -> DataFrame:
    return cells.select(page, "w", "lambda", "k", "version", "intersection", "union_size",
                        jaccard_from_sizes("intersection", "union_size").alias("jaccard"))


def jaccard_to_baseline(shingles: DataFrame, lambdas: Sequence, step: int = STEP,
                        max_back: int = MAX_BACK, page: str = "page") -> DataFrame:
    """shingles[page, version, w, shingles] ->
    [page, w, lambda, k, version, intersection, union_size, jaccard]."""
    grid = lambda_grid_column(lambdas)
    one = F.struct("w", "shingles", _sizes(F.col("shingles"), grid).alias("sizes"))
    rows = shingles.filter(needed_versions("version", step, max_back)).select(
        page, "w", "version", F.xxhash64("shingles").alias("_tie"), one.alias("_cur"))
    pairs = _with_baseline(rows, "_cur", [page, "w"], step, max_back)
    return _finish(pairs.select(page, "version", F.inline(_cells(F.col("_base"), F.col("_cur"), grid))), page)


def sketch_similarity(sketches: DataFrame, step: int = STEP, max_back: int = MAX_BACK, page: str = "page") -> DataFrame:
    """The same from stored sketches [page, version, w, lambda, sketch], each
    lambda from its own sketches."""
    rows = sketches.filter(needed_versions("version", step, max_back)).select(
        page, "w", "lambda", "version", F.xxhash64("sketch").alias("_tie"), "sketch")
    pairs = _with_baseline(rows, "sketch", [page, "w", "lambda"], step, max_back)
    return _finish(pairs.select(
        page, "w", "lambda", lambda_k("lambda").alias("k"), "version",
        intersection_size("_base", "sketch").alias("intersection"), union_size("_base", "sketch").alias("union_size")), page)


def compare_texts(versions: DataFrame, ws: Sequence[int], lambdas: Sequence, step: int = STEP,
                  max_back: int = MAX_BACK, page: str = "page", text_col: str = "text",
                  partitions: int | None = None, prepartitioned: bool = False) -> DataFrame:
    """From texts [page, version, text] straight to similarities.

    Only baseline and target versions are read (the filter reaches the scan or
    the version generator).  The *texts* are dealt by page once and sorted --
    cheaper than moving shingle arrays, which are several times the size of
    their text -- and only the set sizes of each (w, lambda) come back from the
    UDF that hashes them.
    ``prepartitioned=True`` skips the repartition when the caller already
    hash-partitioned the versions by page (Spark still adds an exchange if the
    plan cannot prove it).
    """
    needed = versions.filter(needed_versions("version", step, max_back)).select(
        page, "version", text_col, F.xxhash64(text_col).alias("_tie"))
    if not prepartitioned:
        needed = needed.repartition(partitions or work_partitions(versions.sparkSession), F.col(page))
    needed = needed.sortWithinPartitions(page, "version", "_tie")
    # the window carries texts; digests, many times their size, come behind it and never leave the worker
    texts = needed.select(page, "version", "_tie", F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    pairs = _with_baseline(texts, "_text", [page], step, max_back)
    ws, lams = check_windows(ws), parse_lambdas(lambdas)
    sizes = pairs.select(page, "version", shared_sizes("_base", "_text", ws=ws, ks=[k for _, k in lams]).alias("_sizes"))
    grid = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(label).alias("lambda"), F.lit(k).alias("k")) for w in ws for label, k in lams])
    cells = F.transform(grid, lambda g, i: F.struct(
        g["w"].alias("w"), g["lambda"].alias("lambda"), g["k"].alias("k"),
        F.get("_sizes", 2 * i).alias("intersection"), F.get("_sizes", 2 * i + 1).alias("union_size")))
    return _finish(sizes.select(page, "version", F.inline(cells)), page)


def skipped_pages(catalog: DataFrame, step: int = STEP, max_back: int = MAX_BACK,
                  page: str = "page") -> DataFrame:
    """[page, reason] for pages without version 0 or without any target.

    One aggregation over the (page, version) catalog; partial aggregation
    keeps the shuffle at one row per page and map task.
    """
    per_page = catalog.groupBy(page).agg(
        F.max(F.when(F.col("version") == 0, 1).otherwise(0)).alias("_has_base"),
        F.max(F.when(is_target("version", step, max_back), 1).otherwise(0)).alias("_has_tgt"),
    )
    return per_page.select(
        page,
        F.when(F.col("_has_base") == 0, F.lit("missing version 0"))
        .when(F.col("_has_tgt") == 0, F.lit("no target versions"))
        .alias("reason"),
    ).filter(F.col("reason").isNotNull())


def bit(place: Column) -> Column:
    """A long with the bit of that place set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def has_bit(mask: Column, one: Column) -> Column:
    return mask.bitwiseAND(one) != 0


def missing_versions(required: DataFrame, present: DataFrame, keys: Sequence[str] = ("page", "w", "lambda"),
                     version: str = "version") -> DataFrame:
    """[keys..., version]: required versions that are not present, each once.

    Versions (from any range) become masks of 64, so that a task ships a row for
    each key and 64 versions, not one for each version; what is missing is what
    the masks differ in.  Null versions and keys equal one another."""
    keys = list(keys)
    v = F.col(version).cast("long")
    bucket, own = F.floor(v / BITS).alias("_bucket"), bit(F.pmod(v, F.lit(BITS)).cast("int"))
    none = F.lit(0).cast("long")

    def marked(df: DataFrame, want: Column, have: Column) -> DataFrame:
        return df.select(*keys, bucket, want.alias("_want"), have.alias("_have"))
    one = F.when(v.isNull(), 1).otherwise(own)
    masks = (marked(required, one, none).unionByName(marked(present, none, one))
             .groupBy(*keys, "_bucket").agg(F.bit_or("_want").alias("_want"), F.bit_or("_have").alias("_have")))
    gone = F.col("_want").bitwiseAND(F.bitwise_not("_have"))
    kind = required.schema[version].dataType
    places = F.filter(F.array(*[F.lit(k) for k in range(BITS)]), lambda k: has_bit(gone, bit(k)))
    return masks.filter(gone != 0).select(*keys, "_bucket", F.explode(places).alias("_k")).select(
        *keys, (F.col("_bucket") * BITS + F.col("_k")).cast(kind).alias(version))


def missing_sketches(required: DataFrame, present: DataFrame,
                     keys: Sequence[str] = ("page", "version", "w", "lambda")) -> DataFrame:
    """Required (page, version, w, lambda) rows absent from a sketch table, each once."""
    keys = list(keys)
    if "version" not in keys:
        return required.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")
    return missing_versions(required, present, [k for k in keys if k != "version"]).select(*keys)


def assert_complete(required: DataFrame, present: DataFrame,
                    keys: Sequence[str] = ("page", "version", "w", "lambda"), show: int = 5) -> None:
    """Fail naming the first missing keys (one action, a bounded ``take``)."""
    missing = missing_sketches(required, present, keys).take(show)
    if missing:
        listed = ", ".join(str(r.asDict()) for r in missing)
        raise RuntimeError(
            f"sketches missing for {listed}; generate them first (shingle + sketch)")
