"""Sketch tables that are dealt by page once, when they are written.

A table of the catalog, partitioned by (w, lambda) and bucketed by page, its
files sorted by (page, version).  Comparisons deal by page, so a plan over such a
table scans, sorts inside each bucket and compares, without an exchange, as often
as it is read.  Files stay at a path of the caller's; a later session names the
table again over the same path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cells import folder_of
from .sinks import SKETCH_SCHEMA


def bucketed_table(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The table ``name`` over the files at ``path`` (which may be there already).

    ``buckets`` must be what the files were written with; about 128 to 512 MB of
    sketches of a (w, lambda) a bucket is a good size.
    """
    if buckets <= 0:
        raise ValueError("buckets must be positive")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SKETCH_SCHEMA)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic') "
              f"PARTITIONED BY (w, `lambda`) CLUSTERED BY (page) SORTED BY (page, version) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    folder, fs = folder_of(spark, path)
    fs.mkdirs(folder)
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_bucketed(sketches: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Write [page, version, n_tokens, sketch, w, lambda]; only the (w, lambda) that
    are written are replaced.  One exchange, and one file for each bucket and (w, lambda)."""
    table = bucketed_table(sketches.sparkSession, name, path, buckets)
    rows = sketches.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in SKETCH_SCHEMA])
    rows.repartition(int(buckets), "page").write.insertInto(name, overwrite=True)
    return table.sparkSession.table(name)
