"""Version masks equal the array form and plain sets; completeness by masks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from revdrift.functions.text import shingles, tokenize
from revdrift.operators import bitmaps, compare
from revdrift.operators.shingle import shingle
from revdrift.plans import fixtures as fx
from revdrift.plans import queries as Q
from support import SF_SMALL

COLUMNS = ["page", "w", "version", "intersection", "union_size", "jaccard"]


def rows_of(df, columns=COLUMNS):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk", [30, 1 << 16])
def test_masks_equal_the_array_form(spark, chunk):
    chain = fx.revision_chain(fx.read_table(spark, SF_SMALL, "documents"))
    got = bitmaps.jaccard_from_masks(bitmaps.version_masks(chain, (2, 25, 50), chunk_tokens=chunk))
    want = compare.compare_texts(chain, (2, 25, 50), ("inf",))
    assert rows_of(got) == rows_of(want)


def test_odd_rows(spark):
    words = [f"t{k}" for k in range(40)]
    text = " ".join(words)
    rows = [("a", 0, text), ("a", 3, text + " x"), ("a", 6, None), ("a", 9, ""), ("a", 4, "no target"), ("a", 150, "too far"), ("a", -3, "negative"),
            ("b", 3, text), ("b", 6, text),  # no version 0
            ("c", 0, None), ("c", 3, "few"), ("c", 6, text),  # an empty baseline
            ("d", 0, text), ("d", 0, text), ("d", 3, text), ("d", 3, text), ("d", 6, " ".join(words[::-1])), ("d", 6, text),
            (None, 0, text), (None, 3, text)]
    df = spark.createDataFrame([(p, v, t, 7, b"d") for p, v, t in rows], "page string, version int, text string, mask long, digest binary")
    got = bitmaps.jaccard_from_masks(bitmaps.version_masks(df, (5,), chunk_tokens=7))
    want = compare.compare_texts(df.filter("version >= 0"), (5,), ("inf",))
    assert rows_of(got) == rows_of(want)
    assert {r.page for r in got.collect()} == {"a", "c", "d", None}
    empty = bitmaps.version_masks(df.limit(0), (5,))
    assert empty.collect() == [] and bitmaps.jaccard_from_masks(empty).collect() == [] and bitmaps.set_sizes(empty).collect() == []
    for bad in (lambda: bitmaps.version_masks(df, ()), lambda: bitmaps.version_masks(df, (5,), chunk_tokens=0),
                lambda: bitmaps.version_bit(step=1, max_back=147), lambda: bitmaps.set_members(empty, [0], "some"),
                lambda: bitmaps.set_members(empty, [], "all")):
        with pytest.raises(ValueError):
            bad()


def test_set_members_and_sizes_equal_plain_sets(spark):
    chain = fx.revision_chain(fx.read_table(spark, SF_SMALL, "documents"))
    masks = bitmaps.version_masks(chain, (25,), unique=True).cache()
    sets = {}
    for r in chain.filter(compare.needed_versions()).select("page", "version", shingles("text", 25).alias("s")).collect():
        sets.setdefault(r.page, {})[r.version] = {bytes.fromhex(h) for h in r.s}
    for how, combine in (("all", set.intersection), ("any", set.union)):
        got = {}
        for r in bitmaps.set_members(masks, [0, 3, 63], how).collect():
            got.setdefault(r.page, set()).add(bytes(r.digest))
        assert got == {p: m for p, v in sets.items() if (m := combine(v[0], v[3], v[63]))}
    want = {p: (len(v), len(set.intersection(*v.values())), len(set.union(*v.values()))) for p, v in sets.items()}
    assert {r.page: (r.n_versions, r.n_shared, r.n_union) for r in bitmaps.set_sizes(masks).collect()} == want
    masks.unpersist()


def test_plan_joins_no_digests_and_holds_no_arrays_of_them(spark):
    plan = plan_of(Q.q_jaccard_by_masks(spark, SF_SMALL))
    assert "array_intersect" not in plan and "array_union" not in plan and "Join" not in plan and "Python" not in plan


def test_versions_of_a_chunk_are_merged_before_the_shuffle(spark):
    """What a map task ships for a digest is one row, however many versions hold it."""
    words = " ".join(f"t{k}" for k in range(2000))
    df = spark.createDataFrame([("p", v, words) for v in range(0, 148, 3)], "page string, version int, text string").repartition(8)
    masks = bitmaps.version_masks(df, (5,), unique=True)
    assert masks.count() == 1996 and masks.select("mask").distinct().count() == 1
    plan = plan_of(masks)
    assert plan.index("partial_bit_or") > plan.index("bit_or(_bit")  # a partial aggregation stands below
    assert plan.count("Exchange hashpartitioning(page") == 2  # chunks, then digests


def edited(rng, words):
    """Versions of a list of words: cuts, changes and insertions here and there."""
    out = list(words)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(out) + 1)
        out[at:at + rng.randrange(4)] = [f"n{rng.randrange(5)}" for _ in range(rng.randrange(4))]
    return out[rng.choice([0, 0, 3]):len(out) - rng.choice([0, 0, 2])]


@pytest.mark.parametrize("chunk", [1, 4, 7, 20, 1 << 16])
def test_shared_stretches_hold_what_plain_sets_do(spark, chunk):
    """windows shared with the first version of a chunk get all their versions' bits."""
    rng = random.Random(chunk)
    rows, held = [], {}
    for page in "abcdefgh":
        base = [f"t{rng.randrange(9 if page < 'd' else 900)}" for _ in range(rng.choice([0, 4, 30, 60]))]
        for version in rng.sample(range(0, 148, 3), 6):
            words = edited(rng, base)
            rows += [(page, version, " ".join(words))] * rng.choice([1, 1, 2])
            for w in (1, 2, 5):
                of = held.setdefault((page, w), {})
                of[None] = of.get(None, 0) | 1 << version // 3
                for i in range(len(words) - w + 1):
                    coded = b"".join(len(x).to_bytes(4, "big") + x.encode() for x in words[i:i + w])
                    digest = hashlib.md5(coded).digest()
                    of[digest] = of.get(digest, 0) | 1 << version // 3
    df = spark.createDataFrame(rows, "page string, version int, text string")
    got = {}
    for r in bitmaps.version_masks(df, (1, 2, 5), chunk_tokens=chunk).collect():
        of = got.setdefault((r.page, r.w), {})
        of[None] = of.get(None, 0) | r["mask"]  # all versions, those without a shingle too
        if r.digest is not None:
            of[bytes(r.digest)] = r["mask"]
    assert got == held


def test_shared_windows_are_hashed_once(spark):
    words = [f"t{k}" for k in range(500)]
    texts = [words, words[3:], words[:250] + ["edit"] + words[250:], words[:-9], words]
    df = spark.createDataFrame([("p", 3 * k, " ".join(t)) for k, t in enumerate(texts)], "page string, version int, text string")
    assert plan_of(bitmaps.version_masks(df, (5, 25), unique=True)).count("md5(") == 2
    parts = df.select("page", F.lit(0).alias("_c"), bitmaps.version_bit().alias("_own"), tokenize("text").alias("_part"))
    hashed = bitmaps._with_stretches(parts, (5, 25), 1 << 16, "page").groupBy("w").agg(F.sum(F.col("_to") - F.col("_from")).alias("n"))
    assert {r.w: r.n for r in hashed.collect()} == {5: 496 + 5, 25: 476 + 25}  # and not five times as many


def test_chunks_are_dealt_as_text(spark):
    """no list of tokens is shuffled."""
    df = spark.createDataFrame([("p", 0, " a  b "), ("p", 3, None), ("p", 6, "")], "page string, version int, text string")
    masks = bitmaps.version_masks(df, (1,), unique=True)
    dealt = plan_of(masks).split("REPARTITION_BY_NUM")[1]
    assert "concat_ws( , slice(" in dealt[:dealt.index("Generate")]
    assert sorted((r["mask"], r.digest is None) for r in masks.collect()) == [(1, False), (1, False), (6, True)]


def test_page_of_a_million_tokens(spark):
    """Rows of the plan hold a chunk's digests at most."""
    rng = random.Random(1)
    words = [f"t{rng.randrange(1000)}" for _ in range(260_000)]
    versions = {0: words, 3: words[3:], 6: words[:200_000], 9: words[::-1]}
    df = spark.createDataFrame([("p", v, " ".join(t)) for v, t in versions.items()], "page string, version int, text string")
    got = {r.version: (r.intersection, r.union_size) for r in
           bitmaps.jaccard_from_masks(bitmaps.version_masks(df, (8,), unique=True)).collect()}
    sets = {v: {tuple(t[i:i + 8]) for i in range(len(t) - 7)} for v, t in versions.items()}
    assert got == {v: (len(sets[0] & sets[v]), len(sets[0] | sets[v])) for v in (3, 6, 9)}


def test_missing_versions_are_what_an_anti_join_finds(spark):
    rng = random.Random(2)
    pages, lambdas = ["a", "b", None], ["8", "inf"]
    required = [(p, v, lam) for p in pages for v in [*range(0, 300, 7), -70, -1, 2 ** 40] for lam in lambdas if rng.random() < 0.7]
    present = [r for r in required if rng.random() < 0.6] + [("z", 3, "8"), ("a", 5000, "8")]
    need = spark.createDataFrame(required + required[:5] + [("a", None, "8"), ("b", None, "8")], "page string, version long, lambda string")
    have = spark.createDataFrame(present + [("b", None, "8")], "page string, version long, lambda string")
    got = compare.missing_sketches(need, have, ("page", "version", "lambda"))
    assert got.columns == ["page", "version", "lambda"] and dict(got.dtypes)["version"] == "bigint"
    want = (set(required) - set(present)) | {("a", None, "8")}
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert "Join" not in plan_of(got)
    assert compare.missing_sketches(need, need, ("page", "version", "lambda")).collect() == []
    assert compare.missing_sketches(need.limit(0), have, ("page", "version", "lambda")).collect() == []
