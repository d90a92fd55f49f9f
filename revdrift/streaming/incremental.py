"""Incremental shingling of newly landed versions with Structured Streaming.

The batch job re-reads a whole corpus; when versions keep landing (one table
of [page, version, text] rows appended over time, e.g. the per-version text
sink), the same shingle + sketch operators run as a stateless stream: each
micro-batch is shingled and appended to the partitioned sketch table.  The
checkpoint lives in the cluster's shared ``spark.checkpoint.dir`` so a lost
driver or executor resumes exactly where it stopped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.shingle import shingle, sketch
from ..session import scratch_path
from ..sources.sinks import written_by

VERSION_SCHEMA = "page string, version int, text string"


def stream_versions(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of [page, version, text] landing in ``source_dir``."""
    return (spark.readStream.schema(VERSION_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))


def start_sketching(spark: SparkSession, source_dir: str, sketch_path: str,
                    ws: Sequence[int] = (25, 50), lambdas: Sequence = ("8", "16", "32", "64", "inf"),
                    checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Shingle + sketch every new version and append it to ``sketch_path``.

    The parquet file sink commits each micro-batch through its metadata log,
    so a replayed batch after a failure is not written twice; the table is
    partitioned by (w, lambda) like the batch sketch table.
    """
    if written_by(spark, sketch_path) == "batch":
        raise RuntimeError(f"{sketch_path} holds a batch table; a stream needs a folder of its own")
    name = hashlib.sha256(f"{source_dir}\n{sketch_path}".encode()).hexdigest()[:24]  # one for each source and sink
    versions = stream_versions(spark, source_dir)
    sketches = sketch(shingle(versions, ws), lambdas).select(
        "page", "version", "n_tokens", "sketch", "w", "lambda")
    writer = (sketches.writeStream.format("parquet").partitionBy("w", "lambda")
              .option("path", sketch_path)
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"sketch-stream-{name}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
