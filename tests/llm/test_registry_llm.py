"""Registered queries against their SQL, and the pipeline against a brute-force version."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest

from revdrift.llm import queries as Q

ROOT = Path(__file__).parents[2]


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, con, small, name):
    df = Q.queries()[name](spark, small)
    rel = con.sql(Q.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    want = sorted((tuple(r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=repr) == want


def test_every_operator_and_the_pipeline_are_registered():
    names = Q.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names


def test_pipeline_equals_brute_force(spark, small):
    import corpus_pipeline as C

    from brute import brute_near

    docs = spark.read.parquet(f"{small}/documents.parquet")
    clean = C.drop_poor(spark, C.drop_toxic(spark, docs, small), small)
    assert clean.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert 0.5 * docs.count() < len(rows) < docs.count()
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = [(i, t) for t, i in last.items()]
    want = {i for i, _, _, kept in brute_near(rows) if kept}
    got = Q.pipeline(spark, small)
    assert {r.doc_id for r in got.collect()} == want
    assert [n for n, _ in C.STAGES] == ["toxicity", "quality", "exact_dedup", "near_dedup", "packing"]


def test_pipeline_with_odd_rows(spark, odd_docs, small):
    import corpus_pipeline as C

    docs = odd_docs.select("doc_id", "text", "lang")
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang"]
    assert C.STAGES[-1][1](spark, docs, small).count() >= docs.count()
    empty = odd_docs.limit(0)
    for _, stage in C.STAGES[:-1]:
        empty = stage(spark, empty, small)
    assert C.STAGES[-1][1](spark, empty, small).collect() == []


def test_native_operator_runs_no_python(spark, small):
    plan = Q.op8_license_scan(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "revdrift").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p
    code = "import sys, importlib.util as u\nf = u.find_spec\nu.find_spec = lambda n, *a: None if n == 'revdrift.llm' else f(n, *a)\n" \
           "import __spark_entry__ as e\nassert e.queries() and 'pipeline' not in e.queries() and 'revdrift.llm' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
