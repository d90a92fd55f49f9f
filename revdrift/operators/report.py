"""Reports over a similarity table [page, w, lambda, version, jaccard].

The published figures are computed from the six-decimal *rendered*
similarities (the reference reads its own CSVs back), so every report here
works on ``jaccard_6dp`` turned into exact integer micro-units: sums are
exact and independent of shuffle order, and the only floating-point step is
the final division.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import INF_LABEL, lambda_k
from ..functions.render import six_decimals
from ..functions.similarity import micro_units
from .shingle import parse_lambdas


def render(sim: DataFrame) -> DataFrame:
    """Add ``jaccard_6dp`` (text, exact ``%.6f``) and ``jaccard_micro`` (long)."""
    out = sim.withColumn("jaccard_6dp", six_decimals("jaccard"))
    return out.withColumn("jaccard_micro", micro_units(F.col("jaccard_6dp").cast("double")))


def detailed(sim: DataFrame, page: str = "page") -> DataFrame:
    """The detailed table: one row per (page, w, lambda, version), 6-dp value."""
    return render(sim).select(page, "w", "lambda", "version",
                              F.col("jaccard_6dp").cast("double").alias("jaccard"))


def _micro(sim: DataFrame) -> DataFrame:
    return sim if "jaccard_micro" in sim.columns else render(sim)


def lambda_mae(sim: DataFrame, lambdas: Sequence = ("8", "16", "32", "64"),
               page: str = "page", ws: Sequence[int] | None = None) -> DataFrame:
    """[w, lambda, n_pairs, mae_vs_infty] for every finite lambda of the grid.

    J_lambda is matched with J_inf of the same (w, page, version) by one hash
    aggregation on those keys (no join); that aggregation needs no exchange
    when the input is already partitioned by page.  A lambda with nothing
    comparable gets NaN, as in the reference; with ``ws`` so does every lambda
    of a window size without any pair.
    """
    finite = [lab for lab, _ in parse_lambdas(lambdas) if lab != INF_LABEL]
    s = _micro(sim).filter(F.col("lambda").isin(*finite, INF_LABEL))
    per_pair = s.groupBy("w", page, "version").agg(
        F.max(F.when(F.col("lambda") == INF_LABEL, F.col("jaccard_micro"))).alias("_inf"),
        *[F.max(F.when(F.col("lambda") == lab, F.col("jaccard_micro"))).alias(f"_l{lab}")
          for lab in finite],
    )
    errs = per_pair.select(
        "w",
        F.inline(F.array(*[
            F.struct(F.lit(lab).alias("lambda"),
                     F.abs(F.col(f"_l{lab}") - F.col("_inf")).alias("err"))
            for lab in finite])),
    )
    # count(err) skips the unmatched (NULL) errors; a lambda with none gets NaN.
    agg = errs.groupBy("w", "lambda").agg(
        F.count("err").alias("n_pairs"), F.sum("err").alias("_sum"))
    if ws is not None:
        cells = [(int(w), lab) for w in ws for lab in finite]
        grid = sim.sparkSession.createDataFrame(cells, "w int, `lambda` string")
        agg = grid.join(agg, ["w", "lambda"], "left").select(
            "w", "lambda", F.coalesce("n_pairs", F.lit(0)).cast("long").alias("n_pairs"), "_sum")
    return agg.select(
        "w", "lambda", "n_pairs",
        F.when(F.col("n_pairs") == 0, F.lit(float("nan")))
        .otherwise(F.col("_sum").cast("double") / F.col("n_pairs") / F.lit(1e6))
        .alias("mae_vs_infty"),
    )


def best_lambda(mae: DataFrame) -> DataFrame:
    """[w, best_lambda, best_mae]: smallest MAE, ties to the smaller lambda,
    NaN never wins; a w with nothing comparable gets NULLs."""
    ranked = mae.withColumn("_k", lambda_k("lambda"))
    best = ranked.groupBy("w").agg(F.min(F.when(
        ~F.isnan("mae_vs_infty"), F.struct("mae_vs_infty", "_k", "lambda"))).alias("_b"))
    return best.select(
        "w", F.col("_b.lambda").alias("best_lambda"), F.col("_b.mae_vs_infty").alias("best_mae"))


def similarity_series(sim: DataFrame, page: str = "page") -> DataFrame:
    """page -> w -> lambda -> points ordered by version (bounded: targets only)."""
    s = _micro(sim)
    return s.groupBy(page, "w", "lambda").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("version"), F.col("jaccard_6dp").cast("double").alias("jaccard")))).alias("points"))


def series_summary(sim: DataFrame, page: str = "page") -> DataFrame:
    """Flat view of the series: size, first/last point, lambda sort key."""
    ser = similarity_series(sim, page)
    return ser.select(
        page, "w", "lambda", lambda_k("lambda").alias("lambda_order"),
        F.size("points").alias("n_points"),
        F.col("points")[0]["version"].alias("first_version"),
        F.col("points")[0]["jaccard"].alias("first_jaccard"),
        F.element_at("points", -1)["version"].alias("last_version"),
        F.element_at("points", -1)["jaccard"].alias("last_jaccard"),
    )


def curves_wide(sim: DataFrame, lambdas: Sequence = ("8", "16", "32", "64", "inf"),
                page: str = "page") -> DataFrame:
    """One row per (page, w, version), one column per lambda (lam_8 ... lam_inf)."""
    labels = [lab for lab, _ in parse_lambdas(lambdas)]
    s = _micro(sim).withColumn("_j", F.col("jaccard_6dp").cast("double"))
    wide = s.groupBy(page, "w", "version").pivot("lambda", labels).agg(F.first("_j"))
    return wide.select(page, "w", "version", *[F.col(f"`{lab}`").alias(f"lam_{lab}") for lab in labels])
