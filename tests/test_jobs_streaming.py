"""Composite jobs and the incremental (streaming) sketcher."""

import os

import pytest

from pyspark.sql import functions as F

from revdrift.plans import jobs
from revdrift.sources import sinks
from revdrift.streaming.incremental import start_sketching


def _versions(spark):
    return spark.createDataFrame(
        [("p", 0, "a b c d e f"), ("p", 3, "a b c d e g"), ("p", 6, ""), ("q", 3, "x y z")],
        "page string, version int, text string")


def test_similarity_and_quality(spark):
    sim = jobs.similarity(_versions(spark), ws=[2], lambdas=["1", "inf"])
    got = {(r.page, r.version, r["lambda"]): r.jaccard_6dp for r in sim.collect()}
    assert got[("p", 3, "inf")] == f"{4 / 6:.6f}"
    assert got[("p", 6, "inf")] == "0.000000"
    assert ("q", 3, "inf") not in got  # page without version 0 is skipped
    mae, best = jobs.lambda_quality(sim, ["1", "inf"])
    assert best.first().best_lambda == "1"


def test_similarity_from_sketch_table(spark, scratch):
    path = os.path.join(scratch, "sk")
    table = jobs.materialize_sketches(spark, _versions(spark), path, ws=[2], lambdas=["1", "inf"])
    a = jobs.similarity_from_sketches(table, ["1", "inf"]).select("page", "w", "lambda", "version", "jaccard")
    b = jobs.similarity(_versions(spark), [2], ["1", "inf"]).select("page", "w", "lambda", "version", "jaccard")
    assert sorted(a.collect()) == sorted(b.collect())


def test_similarity_from_sketches_names_what_is_missing(spark, scratch):
    table = jobs.materialize_sketches(spark, _versions(spark), os.path.join(scratch, "sk"), ws=[2], lambdas=["1", "2"])
    want = jobs.similarity(_versions(spark), [2], ["1", "2"]).select("page", "w", "lambda", "version", "jaccard")
    got = jobs.similarity_from_sketches(table, ["1", "2"]).select("page", "w", "lambda", "version", "jaccard")
    assert sorted(got.collect()) == sorted(want.collect())
    with pytest.raises(RuntimeError, match="'lambda': 'inf'"):
        jobs.similarity_from_sketches(table, ["1", "inf"])
    less = table.filter(~((F.col("version") == 3) & (F.col("lambda") == "2")))
    with pytest.raises(RuntimeError, match="'version': 3"):
        jobs.similarity_from_sketches(less, ["1", "2"], catalog=_versions(spark))
    with pytest.raises(RuntimeError):
        jobs.similarity_from_sketches(table.limit(0), ["1"])


def test_repeated_versions_count_once(spark):
    twice = _versions(spark).unionByName(_versions(spark))
    assert sorted(jobs.similarity(twice, [2], ["1", "inf"]).collect()) == sorted(jobs.similarity(_versions(spark), [2], ["1", "inf"]).collect())


def test_similarity_read_through_computes_only_absent_cells(spark, scratch, monkeypatch):
    asked, compute = [], jobs.similarity
    monkeypatch.setattr(jobs, "similarity", lambda v, ws, lams: asked.append((ws, lams)) or compute(v, ws, lams))
    path = os.path.join(scratch, "sim")
    jobs.materialize_similarity(spark, _versions(spark), path, [2], ["1", "inf"])
    both = jobs.materialize_similarity(spark, _versions(spark), path, [2, 3], ["1", "inf"])
    cols = ["page", "w", "lambda", "version", "jaccard_6dp"]
    assert sorted(both.select(cols).collect()) == sorted(compute(_versions(spark), [2, 3], ["1", "inf"]).select(cols).collect())
    jobs.materialize_similarity(spark, _versions(spark), path, [3], ["1"], refresh=True)
    assert asked == [([2], ["1", "inf"]), ([3], ["1", "inf"]), ([3], ["1"])]


def test_revision_without_html_is_an_error(spark):
    import datetime as dt
    revs = spark.createDataFrame([("P_XX", i, dt.datetime(2024, 1, 1 + i)) for i in range(7)], "page string, revid long, timestamp timestamp")
    html = spark.createDataFrame([(6, "<p>x</p>"), (3, None), (0, "<p>y</p>")], "revid long, html string")
    with pytest.raises(RuntimeError, match="^no rendered HTML for revision 3 of P_XX$"):
        jobs.revision_corpus(revs, html, 3, 6)


def test_revision_texts_read_each_side_once(spark, scratch):
    import datetime as dt
    revs = spark.createDataFrame([("P_XX", 1, dt.datetime(2024, 1, 1))], "page string, revid long, timestamp timestamp")
    html = spark.createDataFrame([(1, "<p>x</p>")], "revid long, html string")
    for name, df in (("r", revs), ("h", html)):
        df.write.parquet(os.path.join(scratch, name))
    plan = jobs.revision_texts(spark.read.parquet(os.path.join(scratch, "r")), spark.read.parquet(os.path.join(scratch, "h")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_revision_corpus(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    revs = spark.createDataFrame([("P_XX", i, t0 + dt.timedelta(days=i)) for i in range(7)],
                                 "page string, revid long, timestamp timestamp")
    html = spark.createDataFrame([(i, f'<div class="mw-parser-output"><p>rev {i}</p></div>') for i in range(7)],
                                 "revid long, html string")
    out = {r.version: r.text for r in jobs.revision_corpus(revs, html, 3, 6).collect()}
    assert out == {0: "rev 6", 3: "rev 3", 6: "rev 0"}
    cat = jobs.revision_corpus(revs, html, 3, 6, concat=True).first()
    assert cat.text.startswith("rev 6\n" + "=" * 80) and cat.text.endswith("=\n")


def test_streaming_sketcher(spark, scratch):
    src = os.path.join(scratch, "landing")
    _versions(spark).write.parquet(src)
    out = os.path.join(scratch, "sketches")
    q = start_sketching(spark, src, out, ws=[2], lambdas=["inf"], checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 4
    assert got.filter((F.col("page") == "p") & (F.col("version") == 6)).first().sketch == []


def test_study_writes_similarity_once(spark, scratch):
    out = jobs.study(spark, _versions(spark), ws=[2], lambdas=["1", "inf"], path=os.path.join(scratch, "sim"))
    assert out["similarity"].count() == 4
    assert "Scan parquet" in out["mae"]._jdf.queryExecution().executedPlan().toString()
    assert out["best"].first().best_lambda == "1"
    assert out["wide"].count() == 2


def test_streaming_resumes_without_duplicates(spark, scratch):
    src = os.path.join(scratch, "landing2")
    out = os.path.join(scratch, "sketches2")
    ck = os.path.join(scratch, "ck2")
    first = spark.createDataFrame([("p", 0, "a b c")], "page string, version int, text string")
    first.write.mode("append").parquet(src)
    start_sketching(spark, src, out, ws=[2], lambdas=["inf"], checkpoint=ck).awaitTermination(120)
    second = spark.createDataFrame([("p", 3, "a b d")], "page string, version int, text string")
    second.write.mode("append").parquet(src)
    start_sketching(spark, src, out, ws=[2], lambdas=["inf"], checkpoint=ck).awaitTermination(120)
    got = sorted((r.page, r.version) for r in spark.read.parquet(out).collect())
    assert got == [("p", 0), ("p", 3)]
