"""Public composite jobs (the reference's entry points, as DataFrame functions).

Each job returns DataFrames (lazy) or writes tables; nothing is collected to
the driver except bounded metadata (the parameter grid).

* ``shingle_corpus``      -- shingle every version for every w (E1, E6)
* ``sketch_corpus``       -- derive every lambda by truncation (E6, T7)
* ``similarity``          -- Jaccard(C-0, C-v) for the (w, lambda) grid (E2)
* ``lambda_quality``      -- MAE vs inf per (w, lambda) and the best lambda (E3)
* ``materialize_sketches`` and ``materialize_similarity`` -- read-through tables for a grid (E4, S13)
* ``similarity_curves``   -- per-page series and the wide curve table (E5)
* ``runtime_report``      -- timing statistics and the wide timing table (E7)
* ``revision_corpus``     -- revision log + rendered HTML -> versioned texts (E8)
* ``study``               -- similarity written once, every report read from it
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import DEFAULT_ROOTS, html_to_text
from ..operators import compare, report, revisions, runtime
from ..operators.shingle import check_windows, parse_lambdas, shingle, sketch
from ..session import scratch_path, work_partitions
from ..sources import sinks

# The reference's default grid.
DEFAULT_WS = (25, 50)
DEFAULT_LAMBDAS = ("8", "16", "32", "64", "inf")


def shingle_corpus(versions: DataFrame, ws: Sequence[int] = DEFAULT_WS, page: str = "page",
                   partitioned: bool = False) -> DataFrame:
    """[page, version, w, n_tokens, shingles] for every version and w."""
    spark = versions.sparkSession
    return shingle(versions, ws, keys=(page, "version"),
                   partition_by=(page,) if partitioned else None,
                   partitions=work_partitions(spark) if partitioned else None)


def sketch_corpus(versions: DataFrame, ws: Sequence[int] = DEFAULT_WS,
                  lambdas: Sequence = DEFAULT_LAMBDAS, page: str = "page") -> DataFrame:
    """[page, version, w, n_tokens, lambda, k, sketch]: inf computed once, the
    finite lambdas sliced from it."""
    return sketch(shingle_corpus(versions, ws, page), lambdas)


def similarity(versions: DataFrame, ws: Sequence[int] = DEFAULT_WS,
               lambdas: Sequence = DEFAULT_LAMBDAS, step: int = compare.STEP,
               max_back: int = compare.MAX_BACK, page: str = "page") -> DataFrame:
    """Jaccard of every target version with version 0, rendered to 6 decimals."""
    sim = compare.compare_texts(versions, ws, lambdas, step, max_back, page)
    return report.render(sim)


def similarity_from_sketches(sketches: DataFrame, lambdas: Sequence = DEFAULT_LAMBDAS,
                             step: int = compare.STEP, max_back: int = compare.MAX_BACK,
                             catalog: DataFrame | None = None, ws: Sequence[int] | None = None) -> DataFrame:
    """Same, from a stored sketch table [page, version, w, lambda, sketch].

    Each lambda is read from its own partition of the table.  ``catalog``
    [page, version] names the versions that the corpus has (those of the table,
    if it is not given); a sketch that a comparison needs and the table lacks is
    an error that names it.
    """
    labels = [label for label, _ in parse_lambdas(lambdas)]
    asked = sketches.filter(F.col("lambda").isin(*labels))
    if ws is not None:
        asked = asked.filter(F.col("w").isin(*check_windows(ws)))
    known = revisions.catalog(sketches if catalog is None else catalog)
    compared = known.join(compare.skipped_pages(known, step, max_back), "page", "left_anti").filter(
        compare.needed_versions("version", step, max_back))
    sizes = [int(w) for w in ws] if ws is not None else sorted(r[0] for r in sketches.select("w").distinct().collect())
    if not sizes:
        raise RuntimeError("the sketch table is empty")
    grid = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(label).alias("lambda")) for w in sizes for label in labels])
    compare.assert_complete(compared.select("page", "version", F.inline(grid)), asked)
    return report.render(compare.sketch_similarity(asked, step, max_back))


def lambda_quality(sim: DataFrame, lambdas: Sequence = DEFAULT_LAMBDAS,
                   ws: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary[w, lambda, n_pairs, mae_vs_infty], best[w, best_lambda, best_mae]);
    with ``ws`` a row for each cell of the grid, NaN where nothing compares."""
    finite = [lam for lam in lambdas if str(lam).lower() != "inf"]
    mae = report.lambda_mae(sim, finite, ws=ws)
    return mae, report.best_lambda(mae)


def materialize_sketches(spark: SparkSession, versions: DataFrame, path: str,
                         ws: Sequence[int] = DEFAULT_WS, lambdas: Sequence = DEFAULT_LAMBDAS,
                         refresh: bool = False) -> DataFrame:
    grid = [(int(w), str(l)) for w in ws for l in lambdas]
    return sinks.materialize(
        spark, path, grid, lambda w2, l2: sketch_corpus(versions, w2, l2).drop("k"), refresh)


def materialize_similarity(spark: SparkSession, versions: DataFrame, path: str,
                           ws: Sequence[int] = DEFAULT_WS, lambdas: Sequence = DEFAULT_LAMBDAS,
                           refresh: bool = False) -> DataFrame:
    """Read-through similarity table: only the (w, lambda) cells that are not at
    ``path`` are computed, and all are there afterwards or it fails."""
    grid = [(w, label) for w in check_windows(ws) for label, _ in parse_lambdas(lambdas)]
    stored = sinks.materialize_similarity(spark, path, grid, lambda w2, l2: similarity(versions, w2, l2), refresh)
    return stored.filter(F.col("w").isin(*[w for w, _ in grid]) & F.col("lambda").isin(*[lam for _, lam in grid]))


def similarity_curves(sim: DataFrame, lambdas: Sequence = DEFAULT_LAMBDAS) -> tuple[DataFrame, DataFrame]:
    """(series[page, w, lambda, points], wide[page, w, version, lam_*])."""
    return report.similarity_series(sim), report.curves_wide(sim, lambdas)


def runtime_report(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    return runtime.runtime_summary(runs), runtime.runs_wide(runs)


def revision_corpus(revs: DataFrame, rendered: DataFrame, step: int = 3, max_back: int = 147,
                    root_selectors=DEFAULT_ROOTS, concat: bool = False) -> DataFrame:
    """Every ``step``-th revision back to ``max_back`` joined with its rendered
    HTML (``rendered[revid, html]``) and reduced to text.

    Returns [page, version, text] (or [page, n_parts, text] with ``concat``).
    The sampled side is bounded per page, so the join on revid is an ordinary
    shuffle join (or a runtime broadcast when AQE measures it small).  The texts
    are written once to the shared folder and read back.  A sampled revision
    without HTML fails that same job with an error that names it, so neither side
    is read a second time to look for one.
    """
    path = scratch_path(revs.sparkSession, f"revision-corpus-{uuid.uuid4().hex}")
    texts = revision_texts(revs, rendered, step, max_back, root_selectors)
    try:
        texts.write.parquet(path)
    except PySparkException as e:
        named = re.search(r"no rendered HTML for revision \S+ of [^\n]*?(?= SQLSTATE|\n|$)", str(e))
        if named:
            raise RuntimeError(named[0]) from None
        raise
    stored = revs.sparkSession.read.schema(texts.schema).parquet(path)
    return revisions.concat_versions(stored) if concat else stored


def revision_texts(revs: DataFrame, rendered: DataFrame, step: int = 3, max_back: int = 147,
                   root_selectors=DEFAULT_ROOTS) -> DataFrame:
    """[page, version, text] of the sampled revisions, as a plan: one scan of each
    side, and a check in each row that its HTML is there."""
    sampled = revisions.sample_revisions(revs, step, max_back).select(
        "page", F.col("offset").alias("version"), "revid")
    html = rendered.filter(F.col("html").isNotNull()).select("revid", "html")
    absent = F.raise_error(F.concat(F.lit("no rendered HTML for revision "), F.coalesce(F.col("revid").cast("string"), F.lit("null")),
                                    F.lit(" of "), F.coalesce(F.col("page").cast("string"), F.lit("null"))))
    checked = F.when(F.col("html").isNull(), absent.cast("string")).otherwise(F.col("html"))
    return sampled.join(html, "revid", "left").select("page", "version", html_to_text(checked, root_selectors).alias("text"))


def study(spark: SparkSession, versions: DataFrame, ws: Sequence[int] = DEFAULT_WS,
          lambdas: Sequence = DEFAULT_LAMBDAS, path: str | None = None, refresh: bool = False) -> dict[str, DataFrame]:
    """The whole study with the expensive part done once.

    The similarity table (the only stage that shingles) is a read-through table
    at ``path`` -- by default a fresh folder under the cluster's shared
    ``spark.checkpoint.dir`` -- which also cuts the lineage: the reports below
    read that table, so a lost executor never re-shingles the corpus.  With a
    ``path``, cells that an earlier study left there are not computed again.
    """
    target = path or scratch_path(spark, f"similarity-{uuid.uuid4().hex}")
    sim = materialize_similarity(spark, versions, target, ws, lambdas, refresh)
    mae, best = lambda_quality(sim, lambdas, ws)
    series, wide = similarity_curves(sim, lambdas)
    return {"similarity": sim, "mae": mae, "best": best, "series": series, "wide": wide}
