"""Spark results against an independent brute-force Python implementation."""

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from revdrift.operators import compare, report
from revdrift.operators.shingle import shingle, sketch
from revdrift.plans import fixtures as fx

from support import SF_SMALL


def py_shingles(text, w):
    toks = (text or "").lower().split()
    if len(toks) < w:
        return []
    enc = [struct.pack(">I", len(b)) + b for b in (t.encode("utf-8") for t in toks)]
    out = [hashlib.md5(b"".join(enc[i:i + w])).hexdigest() for i in range(len(enc) - w + 1)]
    return sorted(out, key=lambda h: int(h, 16))


def py_jaccard(a, b):
    """Shared share of all digests; two empty lists are alike."""
    found = {h: (h in a, h in b) for h in [*a, *b]}
    return sum(map(all, found.values())) / len(found) if found else 1.0


@pytest.fixture(scope="module")
def docs(spark):
    return fx.read_table(spark, SF_SMALL, "documents")


@pytest.mark.parametrize("w", [1, 2, 25])
def test_shingles_match_python(spark, docs, w):
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r.shingles for r in shingle(docs, [w], keys=("doc_id",)).collect()}
    for r in rows:
        assert got[r.doc_id] == py_shingles(r.text, w), r.doc_id


def test_sketch_is_prefix_of_inf(spark, docs):
    sk = sketch(shingle(docs, [5], keys=("doc_id",)), ["8", "inf"], keep_shingles=True)
    bad = sk.filter(F.col("sketch") != F.slice("shingles", 1, F.col("k"))).count()
    assert bad == 0
    sizes = sk.filter(F.col("lambda") == "8").filter(
        F.size("sketch") != F.least(F.lit(8), F.greatest(F.col("n_tokens") - 4, F.lit(0)))).count()
    assert sizes == 0


def test_jaccard_pipeline_matches_python(spark, docs):
    chain = fx.revision_chain(docs)
    lams = ["8", "16", "32", "64", "inf"]
    sim = compare.compare_texts(chain, [5, 25], lams)
    got = {(r.page, r.w, r["lambda"], r.version): r.jaccard for r in sim.collect()}
    texts = {(r.page, r.version): r.text for r in chain.collect()}
    expected = {}
    for (page, version), text in texts.items():
        if not (version % 3 == 0 and version != 0 and version <= 147):
            continue
        for w in (5, 25):
            a_inf = py_shingles(texts[(page, 0)], w)
            b_inf = py_shingles(text, w)
            for lam in lams:
                k = None if lam == "inf" else int(lam)
                a, b = (a_inf, b_inf) if k is None else (a_inf[:k], b_inf[:k])
                expected[(page, w, lam, version)] = py_jaccard(a, b)
    assert got.keys() == expected.keys()
    for key, v in expected.items():
        assert got[key] == v, key
    # J_inf = 1 - v / (n - w + 1) when shingles are distinct and n - v >= w
    mae = {(r.w, r["lambda"]): r.mae_vs_infty for r in report.lambda_mae(sim, lams[:4]).collect()}
    for w in (5, 25):
        for lam in lams[:4]:
            errs = []
            for (page, ww, l2, version), v in expected.items():
                if ww == w and l2 == lam:
                    j = float(f"{v:.6f}")
                    ji = float(f"{expected[(page, w, 'inf', version)]:.6f}")
                    errs.append(abs(j - ji))
            assert abs(mae[(w, lam)] - sum(errs) / len(errs)) < 1e-12
