"""Position of a row inside its group, without sorting a hot group in one task.

``Window.partitionBy(group).orderBy(...)`` sends every row of a group to one
task; a page holding a third of all versions would then be sorted by a single
task.  ``rank_within`` cuts the rows into buckets by all order columns together,
so rows that tie in the first one are cut too: the buckets' bounds (tuples from
an even sample, chosen once and put into the plan as literals) make a row's
bucket a function of the row alone, and each task gets one bucket of all groups.
Rows are numbered inside (group, bucket), and the counts of the group's earlier
buckets are added.  Both uses of the bucket agree whatever the plan and its
retries do.

The order columns must be unique within a group (as every caller ensures) and
of types that have literals.  The sample decides how even the tasks are, never
a rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_partitions


#: Sampled rows for each bucket.
SAMPLE = 100


def _bucket(key: Column, bounds: list[Column], low: int = 0) -> Column:
    """How many of the ascending ``bounds`` are <= key, by halving."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key >= bounds[mid], _bucket(key, bounds[mid + 1:], low + mid + 1)).otherwise(
        _bucket(key, bounds[:mid], low))


def with_bucket(df: DataFrame, group: str, order: Sequence[str], n: int, out: str = "_bucket") -> DataFrame:
    """``df`` with one of ``n`` ranges, of about equal rows, of all order columns together.

    Nulls are least.  The bounds come from ``SAMPLE * n`` rows or so, those whose
    hash of group and order is small."""
    rows, wanted = df.count(), SAMPLE * n
    keys = df.select(group, *order)
    if rows > wanted:
        keys = keys.filter(F.pmod(F.xxhash64(group, *order), F.lit(1 << 40)) < (wanted << 40) // rows)
    sample = [tuple(r) for r in keys.select(*order).orderBy(*order).collect()]
    bounds = list(dict.fromkeys(sample[len(sample) * k // n] for k in range(1, n))) if sample else []
    types = [df.schema[c].dataType for c in order]
    literals = [F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(b, types, order)]) for b in bounds]
    return df.withColumn(out, _bucket(F.struct(*order), literals))


def rank_within(df: DataFrame, group: str, order: Sequence[str], out: str = "rank",
                descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Add ``out``: 0-based position of the row inside ``group`` by ``order``."""
    n = buckets or work_partitions(df.sparkSession)
    rows = with_bucket(df, group, order, n)
    by = [F.desc(c) if descending else F.asc(c) for c in order]
    numbered = rows.repartitionById(n, F.col("_bucket")).withColumn("_at", F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*by)))
    before = (Window.partitionBy(group).orderBy(F.desc("_bucket") if descending else F.asc("_bucket"))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n")).select(
        F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = numbered.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn(out, (F.col("_off") + F.col("_at") - 1).cast("int")).select(*df.columns, out)
