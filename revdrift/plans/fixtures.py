"""Versioned corpora derived by Spark from the driver tables.

The reference works on pages with numbered versions; the test tables have
none, so each corpus below is *derived* from a whole table (no id subsets,
no caps), and the same derivation is spelled out in the oracle SQL.

* ``revision_chain`` (F1): every document is a page; version ``v`` is the
  lower-cased token list without its first ``v`` tokens.  The version list
  exercises the target rule: 3, 21, 63, 147 are targets; 7 is not a multiple
  of 3; 150 is past ``max_back``.
* ``sources_as_pages`` (F2): page = source, version = position of the
  document inside its source (doc_id order).
* ``editions`` (F2b): page = source/lang, version = the document's position
  inside its *source*, so some pages have no version 0 or no target; used by
  the skip and catalog reports.
* ``event_revisions`` (F3): the events table read as a revision log
  (page = user, revid = event, newest first).
* ``runs_from_events`` (F4): the events table read as timing runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..operators.ranking import rank_within
from ..session import table_path, work_partitions

# Versions generated per page in the revision chain.
CHAIN_VERSIONS = (0, 3, 7, 21, 63, 147, 150)

# Run-table mapping of event types to lambda labels.
EVENT_TYPE_LAMBDA = (("click", "8"), ("view", "16"), ("purchase", "32"),
                     ("signup", "64"), ("error", "inf"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def revision_chain(documents: DataFrame, versions=CHAIN_VERSIONS,
                   partitions: int | None = None) -> DataFrame:
    """[page string, version int, text string] — F1.

    The raw documents are hash-distributed by page first (one shuffle of the
    original text) so that building the versions does not run in as few tasks
    as the input has splits, and every version of a page is born in its page's
    partition; ``partitions=0`` keeps the input layout.
    """
    toks = documents.select(F.col("doc_id").cast("string").alias("page"), "text")
    if partitions != 0:
        toks = toks.repartition(partitions or work_partitions(documents.sparkSession), "page")
    toks = toks.select("page", tokenize("text").alias("_t"))
    fanned = toks.select("page", F.explode(F.array(*[F.lit(int(v)) for v in versions])).alias("version"), "_t")
    return fanned.select(
        "page", "version",
        F.array_join(F.slice("_t", F.col("version") + 1, F.size("_t")), " ").alias("text"))


def sources_as_pages(documents: DataFrame) -> DataFrame:
    """[page, version, doc_id] — F2 (version = rank inside the source).

    The rank is skew-safe (``rank_within``): a source holding a third of all
    documents is numbered by many tasks, not sorted by one.
    """
    ranked = rank_within(documents.select("source", "doc_id"), "source", ["doc_id"], out="version")
    return ranked.select(F.col("source").alias("page"), "version", "doc_id")


def sources_as_pages_upto(documents: DataFrame, max_version: int) -> DataFrame:
    """F2 restricted to versions <= max_version: ``row_number() <= n`` lets
    Catalyst insert a per-partition ``WindowGroupLimit`` before the shuffle.  Only
    the keys are ranked; the texts join afterwards, so that what a map task ships
    for a source is at most ``n`` pairs of numbers."""
    w = Window.partitionBy("source").orderBy("doc_id")
    ranked = documents.select("source", "doc_id", F.row_number().over(w).alias("_rn")).filter(F.col("_rn") <= max_version + 1)
    kept = ranked.select(F.col("source").alias("page"), (F.col("_rn") - 1).cast("int").alias("version"), "doc_id")
    return kept.join(documents.select("doc_id", "text"), "doc_id").select("page", "version", "doc_id", "text")


def editions(documents: DataFrame) -> DataFrame:
    """[page, version] — F2b: page = source || '/' || lang, version = rank in source."""
    ranked = rank_within(documents.select("source", "doc_id", "lang"), "source", ["doc_id"], out="version")
    return ranked.select(F.concat_ws("/", "source", "lang").alias("page"), "version")


def event_revisions(events: DataFrame) -> DataFrame:
    """[page string, revid, parentid, timestamp, user, size, comment]."""
    return events.select(
        F.col("user_id").cast("string").alias("page"),
        F.col("event_id").alias("revid"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("user"),
        F.floor(F.col("value") * 100).cast("long").alias("size"),
        F.col("props").alias("comment"),
    )


def runs_from_events(events: DataFrame) -> DataFrame:
    """[w, lambda, session, run, is_warmup, seconds], a row for each event.

    Consecutive events of a (w, lambda) make timing sessions of four runs, of
    which the first is the warm-up."""
    mapping = F.create_map(*[x for pair in EVENT_TYPE_LAMBDA for x in (F.lit(pair[0]), F.lit(pair[1]))])
    base = events.select(
        F.when(F.col("event_id") % 2 == 0, F.lit(25)).otherwise(F.lit(50)).alias("w"),
        mapping[F.col("event_type")].alias("lambda"),
        "event_id", F.col("value").alias("seconds"))
    ranked = rank_within(base.withColumn("_cell", F.concat_ws("/", "w", "lambda")), "_cell", ["event_id"], out="_rank")
    run = F.col("_rank") % 4
    return ranked.select("w", "lambda", F.floor(F.col("_rank") / 4).cast("int").alias("session"),
                         run.cast("int").alias("run"), (run == 0).alias("is_warmup"), "seconds")
