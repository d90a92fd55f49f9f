"""Bucketed sketch tables: comparisons without an exchange, cells replaced one by one."""

import os
import uuid

import pytest

from revdrift.operators import compare
from revdrift.plans import jobs
from revdrift.sources import buckets

SCHEMA = "page string, version int, text string"
TEXTS = [(p, v, f"a b c d e {p} {v // 6} f g h") for p in ("p", "q", "r", None) for v in (0, 3, 6, 7, 9)]
COLUMNS = ["page", "w", "lambda", "version", "intersection", "union_size", "jaccard"]


def _rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


@pytest.fixture()
def table(spark, scratch):
    name = f"t_{uuid.uuid4().hex}"
    yield name, os.path.join(scratch, "it's a table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_similarity_without_an_exchange(spark, table):
    name, path = table
    versions = spark.createDataFrame(TEXTS, SCHEMA)
    stored = buckets.write_bucketed(jobs.sketch_corpus(versions, [2, 3], ["4", "inf"]), name, path, 4)
    sim = compare.sketch_similarity(stored)
    plan = sim._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert _rows(sim) == _rows(compare.compare_texts(versions, [2, 3], ["4", "inf"]))
    one = compare.sketch_similarity(stored.filter("w = 2 AND lambda = '4'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(w" in plan
    assert _rows(jobs.similarity_from_sketches(stored, ["4", "inf"])) == _rows(sim)


def test_only_written_cells_are_replaced_and_a_later_session_finds_them(spark, table):
    name, path = table
    versions = spark.createDataFrame(TEXTS, SCHEMA)
    buckets.write_bucketed(jobs.sketch_corpus(versions, [2], ["4", "inf"]), name, path, 4)
    buckets.write_bucketed(jobs.sketch_corpus(versions.filter("page = 'p'"), [2], ["4"]), name, path, 4)
    counts = {(r.w, r["lambda"]): r["count"] for r in spark.table(name).groupBy("w", "lambda").count().collect()}
    assert counts == {(2, "4"): 5, (2, "inf"): 20}
    spark.sql(f"DROP TABLE {name}")  # files of a path of the caller's stay
    again = buckets.bucketed_table(spark, name, path, 4)
    assert again.count() == 25
    assert "Exchange" not in compare.sketch_similarity(again)._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table_and_odd_numbers_of_buckets(spark, table):
    name, path = table
    assert buckets.write_bucketed(jobs.sketch_corpus(spark.createDataFrame([], SCHEMA), [2], ["4"]), name, path, 3).count() == 0
    with pytest.raises(ValueError):
        buckets.bucketed_table(spark, name, path, 0)
