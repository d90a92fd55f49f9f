"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Objects that a Python worker keeps.
KEPT = 2
#: Bytes of a batch of rows for Python.
BATCH_BYTES = 4 << 20
_BYTES, _BYTES_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path on the cluster's shared files."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, path: str, **options: Any) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it back."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str, **options: Any) -> DataFrame:
    """Write ``df`` as Parquet to the cluster's shared folder and read it back.

    Cuts the lineage: later stages read files that every executor sees, so a
    lost executor costs a re-read and never a recomputation.
    """
    return stored(df, scratch_folder(df.sparkSession, name), **options)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows reach Python in batches of some ``BATCH_BYTES`` (or one
    longer row), unless the session sets a size of its own.

    Spark's default of 64 MB, times the copies on both sides of the pipe and the
    cores of an executor, is a large part of a small executor."""
    conf = df.sparkSession.conf
    if conf.get(_BYTES, None) == _BYTES_DEFAULT:
        conf.set(_BYTES, str(BATCH_BYTES))
    return df


def partitions(spark: SparkSession) -> int:
    """Tasks for a stage that an explicit repartition() feeds."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


def per_worker(key: Any, build: Callable[[], Any]) -> Any:
    """One object for each Python worker process, kept from task to task
    (tokenizers, lookup tables, bounded caches).  Workers outlive a stage, so
    only the last few are kept."""
    store = sys.modules.setdefault("_revdrift_worker", types.ModuleType("_revdrift_worker"))
    kept = store.__dict__.setdefault("kept", {})
    got = kept.pop(key) if key in kept else build()
    kept[key] = got
    while len(kept) > KEPT:
        del kept[next(iter(kept))]
    return got


def forget(*but: Any) -> None:
    """Drop what this worker keeps of earlier stages, but for some keys, and hand
    back the memory that Arrow and the C library (where it can) hold in reserve."""
    import pyarrow as pa

    kept = getattr(sys.modules.get("_revdrift_worker"), "kept", {})
    for key in [k for k in kept if k not in but]:
        del kept[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def then_forget(run: Callable, *but: Any) -> Callable:
    """``run`` of batches, which leaves a small worker behind: stages of the JVM
    alone follow, and the worker idles beside them."""
    def tidy(batches):
        yield from run(batches)
        forget(*but)
    return tidy


def crc32_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id as decimal text (held-out folds)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))
