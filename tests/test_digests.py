"""Sorted digests by the Arrow UDF: equal to hashlib's, versions hashed once."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revdrift.functions import digests
from revdrift.functions.text import tokenize
from revdrift.operators import bitmaps, compare, longform
from revdrift.operators.shingle import n_distinct, shingle, sketch
from revdrift.plans import queries as Q
from support import SF_SMALL

WORDS = [f"w{i % 37}é{'x' * (i % 5)}" for i in range(120)]
TEXTS = [" ".join(WORDS), " ".join(WORDS[7:]), " ".join(WORDS[:50] + ["new"] + WORDS[51:]), " ".join(WORDS[:-9]), " ".join(WORDS[:-9]),
         None, "", "one", "A  A a A a a", "ab c", "a bc", "x" * 300 + " y", " ".join(["same"] * 40), " ".join(WORDS[3:] + WORDS)]


def plain(words, w, starts=None):
    coded = [len(x.encode()).to_bytes(4, "big") + x.encode() for x in words]
    n = max(len(coded) - w + 1, 0)
    return sorted(hashlib.md5(b"".join(coded[i:i + w])).hexdigest() for i in range(n if starts is None else min(n, starts)))


def words_of(text):
    return (text or "").lower().split()


@pytest.mark.parametrize("least,starts", [(None, None), (3, None), (None, 30), (4, 1)])
def test_lists_equal_hashlib(spark, least, starts):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").coalesce(1)
    got = docs.select("i", digests.digest_lists(tokenize("text"), ws=(1, 5, 25), least=least, starts=starts).alias("l")).collect()
    for r in got:
        assert r.l == [plain(words_of(TEXTS[r.i]), w, starts)[:least] for w in (1, 5, 25)]
    pairs = spark.createDataFrame([(i, a, TEXTS[i - 3]) for i, a in enumerate(TEXTS)], "i int, a string, b string").coalesce(1)
    for r in pairs.select("i", "a", "b", digests.digest_lists(tokenize("a"), tokenize("b"), ws=(2, 9)).alias("l")).collect():
        assert r.l == [plain(words_of(t), w) for t in (r.a, r.b) for w in (2, 9)]


def test_slices_of_a_batch(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)], "i int, text string").coalesce(1)
    monkeypatch.setattr(digests, "SLICE_BYTES", 1)
    got = docs.select("i", digests.digest_lists(tokenize("text"), ws=(3,)).alias("l")).collect()
    assert len(got) == 3 * len(TEXTS) and all(r.l == [plain(words_of((TEXTS * 3)[r.i]), 3)] for r in got)
    assert docs.filter("i < 0").select(digests.digest_lists(tokenize("text"), ws=(3,)).alias("l")).count() == 0


def test_equal_first_halves_are_ordered_by_the_second():
    rows = np.array([[7] * 8 + [9] * 8, [7] * 8 + [1] * 8, [0] * 16, [7] * 8 + [5] * 8], np.uint8)
    assert digests._in_order(rows).tolist() == sorted(rows.tolist())


def test_shared_windows_are_hashed_once(monkeypatch):
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(digests.hashlib, "md5", lambda b, **k: calls.append(1) or md5(b, **k))
    import pyarrow as pa

    near = []
    for words in (WORDS, WORDS[7:], WORDS[:60] + ["edit"] + WORDS[60:], WORDS):
        (text,) = digests._texts(pa.array([words]))
        near = [text.hashed((25,), None, None, near)]
    assert len(calls) < 96 + 7 + 60 + 60  # four versions of 96, 89, 97 and 96 windows


def test_versions_are_hashed_behind_one_exchange(spark):
    """F1 to F8: no array is built and joined for each window, and no digest is shuffled."""
    docs = spark.createDataFrame([("p", v, t) for v, t in zip((0, 3, 6), TEXTS)], "page string, version int, text string")
    sim = compare.compare_texts(docs, (2, 25), ("8", "inf"))
    plan = sim._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("Window")
    sets = [[set(plain(words_of(t), w)) for w in (2, 25)] for t in TEXTS[:3]]
    for r in sim.filter("lambda = 'inf'").collect():
        a, b = sets[0][r.w == 25], sets[r.version // 3][r.w == 25]
        assert (r.intersection, r.union_size) == (len(a & b), len(a | b))


@pytest.mark.parametrize("make", [lambda d: shingle(d, (2, 25)), lambda d: longform.bottom_k(d, (2, 25), 8)])
def test_lists_are_made_once(spark, make):
    """F9, F12 to F14: one UDF, above the exchange that deals the texts."""
    docs = spark.createDataFrame([("p", 0, "a b")], "page string, version int, text string").repartition(3, "page")
    plan = make(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "md5(" not in plan
    assert "split(" not in plan[plan.index("REPARTITION_BY_NUM"):]


def test_windows_of_masks_are_joined_from_few_parts(spark):
    """a window of 25 tokens is three strings, not a slice that is joined."""
    docs = spark.createDataFrame([("p", v, t) for v, t in zip((0, 3, 6), TEXTS)], "page string, version int, text string")
    masks = bitmaps.version_masks(docs, (1, 2, 25, 50), unique=True, chunk_tokens=11)
    plan = masks._jdf.queryExecution().executedPlan().toString()
    assert "array_join" not in plan and plan.count("md5(") == 4
    held = {w: {} for w in (1, 2, 25, 50)}
    for w, of in held.items():
        for v in (0, 1, 2):
            for d in plain(words_of(TEXTS[v]), w):
                of[d] = of.get(d, 0) | 1 << v
    got = {w: {} for w in held}
    for r in masks.filter("digest IS NOT NULL").collect():
        got[r.w][bytes(r.digest).hex()] = r["mask"]
    assert got == held


def test_least_digests_are_what_sketches_need(spark):
    docs = spark.createDataFrame([("p", i, t) for i, t in enumerate(TEXTS)], "page string, version int, text string")
    key = ["page", "version", "w"]
    cut = {tuple(r[k] for k in key): r.shingles for r in shingle(docs, (2, 5), least=4).collect()}
    whole = {tuple(r[k] for k in key): r.shingles[:4] for r in shingle(docs, (2, 5)).collect()}
    assert cut == whole and len(cut) == 2 * len(TEXTS)


def test_places_of_repeats_count_sets(spark):
    """the size of a sketch's set comes from the places of repeats, without a set of its strings."""
    docs = spark.createDataFrame([("p", i, t) for i, t in enumerate([*TEXTS, "a b a b a b a c", "x " * 90])], "page string, version int, text string")
    sk = sketch(shingle(docs.coalesce(1), (1, 2, 25), repeats=True), ("1", "3", "8", "inf"))
    got = sk.select("sketch", n_distinct("sketch", "repeats").alias("n")).collect()
    assert len(got) == 12 * (len(TEXTS) + 2) and all(r.n == len(set(r.sketch)) for r in got)
    assert any(r.n < len(r.sketch) for r in got)
    plan = Q.q_sketch_sizes(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "array_distinct" not in plan


def test_shared_windows_are_hashed_once_by_any_md5(monkeypatch):
    import pyarrow as pa

    calls, near = [], []
    monkeypatch.setattr(digests, "md5", lambda b: calls.append(1) or hashlib.md5(b))
    for words in (WORDS, WORDS[7:], WORDS[:60] + ["edit"] + WORDS[60:], WORDS):
        (text,) = digests._texts(pa.array([words]))
        near = [text.hashed((25,), None, None, near)]
    assert 96 <= len(calls) < 96 + 7 + 60 + 60
