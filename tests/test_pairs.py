"""Set sizes of two texts' sketches by the Arrow UDF equal those of plain sets."""

import hashlib
import random

import pytest

from revdrift.functions import pairs
from revdrift.functions.text import INF_K
from revdrift.operators import compare
from revdrift.plans import queries as Q
from support import SF_SMALL

WS, KS = (1, 2, 5), (1, 3, 8, 40, INF_K)


def digests_of(words, w, md5=hashlib.md5):
    coded = [len(x.encode()).to_bytes(4, "big") + x.encode() for x in words]
    return sorted(md5(b"".join(coded[i:i + w])).digest() for i in range(len(words) - w + 1))


def plain(base, text, md5=hashlib.md5):
    out = []
    for w in WS:
        a, b = (digests_of(t.split(), w, md5) for t in (base, text))
        out += [n for k in KS for n in (len(set(a[:k]) & set(b[:k])), len(set(a[:k]) | set(b[:k])))]
    return out


def some_rows(rng, pages=40):
    """(base, text): pages of versions with cuts, changes, insertions and words that recur."""
    rows = []
    for _ in range(pages):
        kinds = rng.choice([3, 20, 500])
        base = [f"w\u00e9{rng.randrange(kinds)}" + "x" * rng.choice([0, 0, 300]) for _ in range(rng.choice([0, 1, 3, 30, 80]))]
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.3:
                words = list(base)
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randrange(5)] = [f"n{rng.randrange(4)}" for _ in range(rng.randrange(5))]
            rows.append((" ".join(base), "\u3000 ".join(words[rng.choice([0, 3]):])))
    return rows


def test_sizes_equal_plain_sets(spark):
    rows = some_rows(random.Random(5))
    df = spark.createDataFrame([(i, b, t) for i, (b, t) in enumerate(rows)], "i int, b string, t string").coalesce(2)
    got = df.select("i", pairs.shared_sizes("b", "t", ws=WS, ks=KS).alias("s")).collect()
    assert len(got) == len(rows) and all(r.s == plain(*rows[r.i]) for r in got)
    assert df.filter("i < 0").select(pairs.shared_sizes("b", "t", ws=WS, ks=KS)).collect() == []


@pytest.mark.parametrize("most", [0, 5, 1 << 18])
def test_equal_halves_and_what_is_forgotten(monkeypatch, most):
    """Digests that differ in one half alone are different, in the first text and in others."""
    class Few:
        def __init__(self, raw):
            d = hashlib.md5(raw).digest()
            self.raw = bytes([d[0] % 3]) * 8 + bytes([d[1] % 5]) * 8

        def digest(self):
            return self.raw
    for md5 in (Few, hashlib.md5):
        monkeypatch.setattr(pairs, "md5", md5)
        monkeypatch.setattr(pairs, "MOST_OTHERS", most)
        first = None
        for base, text in some_rows(random.Random(6)):
            if first is None or first.text != base:
                first = pairs._First(base, WS, KS)
            assert first.sizes(text) == plain(base, text, md5)


def test_no_digest_leaves_the_worker(spark):
    """F3 to F8 and F11: two numbers for each (w, lambda) come back, no list of digests."""
    sim = Q._sim(spark, SF_SMALL)
    plan = sim._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "array_intersect" not in plan and "array_distinct" not in plan
    assert plan.count("split(") == 1  # the chain's own


def test_rows_of_a_page_without_text(spark):
    rows = [("p", 0, None), ("p", 3, ""), ("p", 6, "a b"), ("q", 0, "A b c"), ("q", 3, None), ("q", 6, "a  B c"), ("r", 3, "x")]
    sim = compare.compare_texts(spark.createDataFrame(rows, "page string, version int, text string"), (2,), ("1", "inf"))
    got = {(r.page, r.version, r["lambda"]): (r.intersection, r.union_size, r.jaccard) for r in sim.collect()}
    assert got == {("p", 3, "1"): (0, 0, 1.0), ("p", 3, "inf"): (0, 0, 1.0), ("p", 6, "1"): (0, 1, 0.0), ("p", 6, "inf"): (0, 1, 0.0),
                   ("q", 3, "1"): (0, 1, 0.0), ("q", 3, "inf"): (0, 2, 0.0), ("q", 6, "1"): (1, 1, 1.0), ("q", 6, "inf"): (2, 2, 1.0)}


@pytest.mark.parametrize("least,slice_bytes", [(None, 1 << 20), (3, 1), (None, 200)])
def test_lists_of_texts_equal_hashlib(spark, monkeypatch, least, slice_bytes):
    monkeypatch.setattr(pairs, "SLICE_BYTES", slice_bytes)
    texts = [t for pair in some_rows(random.Random(7)) for t in pair]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(2)
    got = df.select("i", pairs.text_lists("t", WS, least).alias("s")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = [[d.hex() for d in digests_of(texts[r.i].split(), w)][:least] for w in WS]
        assert r.s.lists == want and r.s.n_tokens == len(texts[r.i].split())
        assert r.s.repeats == [[k + 1 for k in range(1, len(x)) if x[k] == x[k - 1]] for x in want]
    assert df.filter("i < 0").select(pairs.text_lists("t", WS)).collect() == []
    plan = Q.q_sketch_sizes(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1  # the chain's own: no version is split in the JVM
