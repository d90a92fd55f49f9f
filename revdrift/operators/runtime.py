"""Runtime statistics over a runs table [w, lambda, run, is_warmup, seconds].

Run 0 of each (w, lambda) is the warm-up and is not measured; the summary is
mean, *population* standard deviation (0.0 for one run), min and max.  Mean
and standard deviation are reported to the nanosecond (9 decimals): floating
sums depend on the order rows meet in, so unrounded values could differ in
the last bit between runs and engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import lambda_display

NS_DIGITS = 9


def measured(runs: DataFrame) -> DataFrame:
    return runs.filter(~F.col("is_warmup"))


def runtime_summary(runs: DataFrame) -> DataFrame:
    m = measured(runs)
    return m.groupBy("w", "lambda").agg(
        F.count("*").alias("n_runs"),
        F.round(F.avg("seconds"), NS_DIGITS).alias("mean"),
        F.round(F.stddev_pop("seconds"), NS_DIGITS).alias("std"),
        F.min("seconds").alias("min"),
        F.max("seconds").alias("max"),
    ).select("w", "lambda", lambda_display("lambda", style="timing").alias("lambda_display"),
             "n_runs", "mean", "std", "min", "max")


def runs_wide(runs: DataFrame, n_runs: int = 3, keys: Sequence[str] = ("w", "lambda")) -> DataFrame:
    """The timing table: w, lambda ('∞' for inf), run1..runN, mean, std, min, max.

    ``keys`` adds what tells timing sessions apart, one row for each."""
    m = measured(runs)
    wide = m.groupBy(*keys).agg(
        *[F.max(F.when(F.col("run") == i, F.col("seconds"))).alias(f"run{i}") for i in range(1, n_runs + 1)],
        F.round(F.avg("seconds"), NS_DIGITS).alias("mean"),
        F.round(F.stddev_pop("seconds"), NS_DIGITS).alias("std"),
        F.min("seconds").alias("min"),
        F.max("seconds").alias("max"),
    )
    return wide.select("w", lambda_display("lambda", style="timing").alias("lambda"),
                       *[k for k in keys if k not in ("w", "lambda")], *[f"run{i}" for i in range(1, n_runs + 1)], "mean", "std", "min", "max")


def grid_axes(pairs: DataFrame):
    """(distinct w ascending, distinct finite lambda ascending) of a (w, lambda) table."""
    ws = pairs.select("w").distinct().orderBy("w")
    lams = (pairs.filter(F.col("lambda") != "inf").select("lambda").distinct()
            .orderBy(F.col("lambda").cast("int")))
    return ws, lams
