"""Plan-shape regressions: the properties the design relies on at scale."""

from pyspark.sql import functions as F

from revdrift.operators import compare, revisions
from revdrift.plans import fixtures as fx
from revdrift.sources import sinks

from support import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_similarity_of_a_stored_corpus_is_one_scan_and_one_exchange(spark, scratch):
    docs = fx.read_table(spark, SF_SMALL, "documents")
    sinks.write_versions(fx.revision_chain(docs), scratch + "/corpus")
    stored = spark.read.parquet(scratch + "/corpus")
    plan = _plan(compare.compare_texts(stored, [25, 50], ["8", "inf"]))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(page#" in plan
    assert "Join" not in plan and plan.count("Sort ") == 1
    chain = compare.compare_texts(fx.revision_chain(docs), [25, 50], ["8", "inf"], prepartitioned=True)
    assert _plan(chain).count("Exchange ") == 1


def test_sampling_limits_before_the_shuffle(spark):
    revs = fx.event_revisions(fx.read_table(spark, SF_SMALL, "events"))
    s = revisions.sample_revisions(revs, 3, 147)
    text = s._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 2   # partial (map side) and final


def test_sketch_scan_prunes_partitions(spark, scratch):
    df = spark.createDataFrame([("p", 0, 3, ["a"], 25, "8")],
                               "page string, version int, n_tokens int, sketch array<string>, w int, lambda string")
    path = scratch + "/sk"
    sinks.write_sketches(df, path)
    text = _plan(sinks.read_sketches(spark, path, w=25, lam="8"))
    assert "PartitionFilters: [isnotnull(w" in text
    assert "lambda#" in text and "= 8" in text
