"""Golden values of the shingle contract and the scalar rules."""

import math

from pyspark.sql import functions as F

from revdrift.functions import (jaccard, lambda_display, lambda_k, lambda_label, safe_name,
                                shingles, sketch, tokenize)
from revdrift.functions.render import six_decimals

G = {
    "a": "6423807d785e84ddfc0f8ebf6a79d43e",
    "b": "db74108f90643358beeb2698432fc0fb",
    "a b": "dfde2bbf6206eb65e6481779e60763b2",
    "ab": "87009490c397a1a92310c5457cb242fb",
    "b c": "9b03d41ed7259ab7615c713686713a86",
    "c d": "5af7a580c2f27baab49e727600cebc2b",
    "c e": "3ae3d4482a12ffbb070dc18b60cd84ac",
    "é": "ba9e23fca9eef1e3fbf87cefe977a14f",
}


def _one(spark, col, rows, schema="text string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_golden_digests(spark):
    rows = [(t, len(t.split())) for t in G]
    got = spark.createDataFrame(rows, "text string, w int").select(
        "text", shingles("text", F.col("w")).alias("s")).collect()
    for r in got:
        assert r.s == [G[r.text]], r.text


def test_length_prefix_separates_token_boundaries():
    assert G["a b"] != G["ab"]


def test_tokenizer_unicode_whitespace(spark):
    texts = ["a\u0085b", "a　b", "x\u001cy", "a​b", "", "  ", "ΟΔΟΣ", "Hello,  World!\tX"]
    got = _one(spark, tokenize("text"), [(t,) for t in texts])
    assert got[0] == ["a", "b"]
    assert got[1] == ["a", "b"]
    assert got[2] == ["x", "y"]
    assert got[3] == ["a​b"]
    assert got[4] == [] and got[5] == []
    assert got[6] == ["ΟΔΟΣ".lower()]
    assert got[7] == ["hello,", "world!", "x"]


def test_fewer_tokens_than_w_is_empty(spark):
    assert _one(spark, shingles("text", 3), [("a b",), ("",)]) == [[], []]


def test_truncate_before_dedup(spark):
    got = spark.createDataFrame([("x x x x y",)], "text string").select(
        shingles("text", 1).alias("s")).select("s", sketch("s", 4).alias("k4")).first()
    assert got.s == ["34001f7cca8b05a83216fb5525640e7f"] * 4 + ["c94bb9239433e6521574bbf38853d181"]
    assert len(set(got.k4)) == 1


def test_sketch_jaccard_cases(spark):
    df = spark.createDataFrame([("a b c d", "a b c e")], "x string, y string").select(
        shingles("x", 2).alias("a"), shingles("y", 2).alias("b"))
    r = df.select(
        jaccard("a", "b").alias("inf"),
        jaccard(sketch("a", 1), sketch("b", 1)).alias("k1"),
        jaccard(sketch("a", 2), sketch("b", 2)).alias("k2"),
        sketch("a", 0).alias("k0"),
    ).first()
    assert r.inf == 0.5 and r.k1 == 0.0 and abs(r.k2 - 1 / 3) < 1e-15 and r.k0 == []


def test_empty_set_rules(spark):
    df = spark.createDataFrame([([], []), ([], ["h"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(jaccard("a", "b")).collect()] == [1.0, 0.0]


def test_six_decimals_half_even(spark):
    df = spark.createDataFrame([(1 / 128,), (1 / 640,), (2 / 3,), (1.0,), (0.0,)], "j double")
    got = [r[0] for r in df.select(six_decimals("j")).collect()]
    assert got == [f"{x:.6f}" for x in (1 / 128, 1 / 640, 2 / 3, 1.0, 0.0)]
    assert got[0] == "0.007812"


def test_lambda_labels(spark):
    df = spark.createDataFrame([("INF",), ("infty",), ("infinite",), ("008",), ("0",), ("-3",)], "l string")
    r = df.select(lambda_label("l").alias("lab")).select(
        "lab", lambda_k("lab").alias("k"), lambda_display("lab").alias("d"),
        lambda_display("lab", "timing").alias("t")).collect()
    assert [x.lab for x in r] == ["inf", "inf", "inf", "8", None, None]
    assert r[0].k == 2147483647 and r[3].k == 8
    assert r[0].d == "∞" and r[3].d == "λ=8" and r[3].t == "8"


def test_safe_name(spark):
    assert _one(spark, safe_name("text"), [("New York/City é",)]) == ["New-York-City--"]
