"""Cells of read-through tables: published whole, by many writers, empty ones too."""

import math
import os
import threading

import pytest

from revdrift.plans import jobs
from revdrift.sources import cells, sinks

SCHEMA = "page string, version int, text string"
TEXTS = [("p", 0, "a b c d e f"), ("p", 3, "a b c d e g"), ("p", 6, "a b x y e g")]
COLUMNS = ["page", "w", "lambda", "version", "jaccard_6dp"]


def test_an_empty_cell_is_a_cell(spark, scratch, monkeypatch):
    asked, compute = [], jobs.similarity
    monkeypatch.setattr(jobs, "similarity", lambda v, ws, lams: asked.append((ws, lams)) or compute(v, ws, lams))
    alone, path = spark.createDataFrame(TEXTS[:1], SCHEMA), os.path.join(scratch, "alone")
    for _ in range(2):
        assert jobs.materialize_similarity(spark, alone, path, [2], ["1", "inf"]).collect() == []
    assert asked == [([2], ["1", "inf"])]  # known as empty, not computed again
    assert cells.published(spark, path) == {(2, "1"): cells.Stored(None, 0), (2, "inf"): cells.Stored(None, 0)}
    study = jobs.study(spark, alone, [2], ["1", "inf"], path)
    assert math.isnan(study["mae"].first().mae_vs_infty)
    refreshed = jobs.materialize_similarity(spark, spark.createDataFrame(TEXTS, SCHEMA), path, [2], ["1"], refresh=True)
    assert refreshed.count() == 2  # the later manifest's cell counts


def test_a_writer_that_ended_early_leaves_nothing_to_read(spark, scratch):
    versions, path = spark.createDataFrame(TEXTS, SCHEMA), os.path.join(scratch, "early")
    rows = jobs.similarity(versions, [2], ["1", "inf"])
    staged = cells.stage(rows, path, [(2, "1"), (2, "inf")])  # ends before it publishes
    assert staged[2, "1"].rows == 2 and cells.published(spark, path) == {}
    with open(os.path.join(path, "job=half.parquet"), "w") as f:
        f.write("no rows")
    os.makedirs(os.path.join(path, cells.MANIFESTS), exist_ok=True)
    with open(os.path.join(path, cells.MANIFESTS, ".00000000000000000001-x.json"), "w") as f:
        f.write('{"w": 2, "lambda')  # a draft that was not renamed
    got = jobs.materialize_similarity(spark, versions, path, [2], ["1", "inf"])
    assert sorted(got.select(COLUMNS).collect()) == sorted(rows.select(COLUMNS).collect())


def test_two_writers_at_once_do_not_double_rows(spark, scratch):
    versions, path = spark.createDataFrame(TEXTS, SCHEMA), os.path.join(scratch, "two")
    both, errors = threading.Barrier(2), []

    def compute(ws, lams):
        both.wait(60)  # neither has published when the other computes
        return jobs.similarity(versions, ws, lams)

    def write(grid):
        try:
            sinks.materialize_similarity(spark, path, grid, compute)
        except Exception as e:  # shown by the assertion below
            errors.append(e)
    writers = [threading.Thread(target=write, args=(g,)) for g in ([(2, "1"), (2, "inf")], [(2, "inf"), (3, "1")])]
    for t in writers:
        t.start()
    for t in writers:
        t.join()
    assert errors == []
    assert {c: at.rows for c, at in cells.published(spark, path).items()} == {(2, "1"): 2, (2, "inf"): 2, (3, "1"): 2}
    want = jobs.similarity(versions, [2], ["1", "inf"]).unionByName(jobs.similarity(versions, [3], ["1"]))
    got = sinks.materialize_similarity(spark, path, [(2, "1"), (2, "inf"), (3, "1")], None)
    assert sorted(got.select(COLUMNS).collect()) == sorted(want.select(COLUMNS).collect())


def test_a_reader_keeps_the_cells_it_was_given(spark, scratch):
    versions, path = spark.createDataFrame(TEXTS, SCHEMA), os.path.join(scratch, "reader")
    before = jobs.materialize_similarity(spark, versions, path, [2], ["1"])
    jobs.materialize_similarity(spark, spark.createDataFrame(TEXTS[:2], SCHEMA), path, [2], ["1"], refresh=True)
    assert before.count() == 2
    assert jobs.materialize_similarity(spark, versions, path, [2], ["1"]).count() == 1


def test_cells_are_pruned_by_folder(spark, scratch):
    table = jobs.materialize_sketches(spark, spark.createDataFrame(TEXTS, SCHEMA), os.path.join(scratch, "pruned"), [2, 3], ["1", "inf"])
    plan = table.filter("w = 2 AND lambda = 'inf'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "job" not in plan.split("ReadSchema")[1]


def test_a_sketch_cell_without_rows_publishes_nothing(spark, scratch):
    path = os.path.join(scratch, "none")
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(RuntimeError, match=r"\(2, '1'\)"):
        jobs.materialize_sketches(spark, empty, path, [2], ["1"])
    assert cells.published(spark, path) == {}
