import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from revdrift.llm import ftrl, language, license_scan, quality, toxicity
from revdrift.llm import queries as Q

SF = "/root/testdata/sf0.01"


def accuracy(spark, rows, table, label):
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/{table}.parquet").select("doc_id", label).collect()}
    held = [(r[2], known[r.doc_id]) for r in rows if r.doc_id in known and r.held_out]
    assert len(held) > 50
    return sum(a == b for a, b in held) / len(held)


@pytest.mark.parametrize("query,label,folds,out", [(Q.op4_quality, "quality", 3, 1), (Q.op5_toxicity, "toxic", 5, 0)])
def test_classifiers_on_held_out_rows(spark, query, label, folds, out):
    rows = query(spark, SF).select("doc_id", "held_out", "predicted", "score").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert accuracy(spark, rows, "labels", label) >= 0.95


def test_language_on_held_out_rows(spark):
    rows = Q.op9_language(spark, SF).select("doc_id", "held_out", "lang_pred", "score").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert accuracy(spark, rows, "documents", "lang") >= 0.97


def test_classifiers_with_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, None), (None, 1), (3, 1), (9, 0), (99, 1)], "doc_id long, quality int")
    weights = quality.QUALITY.fit(odd_docs, labels)
    scored = quality.QUALITY.score(odd_docs, weights, "text", *odd_docs.columns)
    assert scored.count() == odd_docs.count() and set(scored.columns) == set(odd_docs.columns) | {"predicted"}
    by = {r.text: r.score for r in scored.collect()}
    assert by[None] == by[""]
    kept = [quality.QUALITY.choose(odd_docs, weights, k) for k in (0, 1)]
    assert kept[0].columns == odd_docs.columns and sum(k.count() for k in kept) == odd_docs.count()
    assert quality.QUALITY.score(no_docs, weights, "text", "doc_id").collect() == []
    nothing = quality.QUALITY.fit(odd_docs, labels.limit(0))
    assert {r.score for r in quality.QUALITY.score(odd_docs, nothing, "text", "doc_id").collect()} == {0.5}
    model = toxicity.toxicity(no_docs)
    assert model.score(odd_docs, model.fit(no_docs, labels.withColumnRenamed("quality", "toxic")), "text", "doc_id").count() == odd_docs.count()


def test_language_with_odd_rows(spark, odd_docs, no_docs):
    rows = language.predict(odd_docs, language.fit(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows} == {"en", "und"}
    assert [r.score for r in rows if r.lang_pred == "und"] == [0.0] * 5  # two nulls, empty, twice only white space
    assert {r.lang_pred for r in language.predict(odd_docs, {}).collect()} == {"und"}
    assert language.fit(no_docs) == {} and language.predict(no_docs, {}).collect() == []


def test_bundles_are_sums_of_bound_rotated_letters():
    letter, (third, second, first) = language._tables()
    doc, code = language._ngrams(["Ab!c", "", None, "  z"])
    grams = [" ab", "ab ", " c ", " z "]
    number = lambda g: sum(int(letter[ord(c)]) * language.LETTERS ** (2 - k) for k, c in enumerate(g))
    assert sorted(zip(doc.tolist(), code.tolist())) == sorted(zip([0, 0, 0, 3], map(number, grams)))
    base = third
    bound = np.roll(base[letter[ord("x")]], 2) * np.roll(base[letter[ord("y")]], 1) * base[letter[ord("z")]]
    assert (language._vectors(np.array([number("xyz")]))[0] == bound).all()


def test_ftrl_follows_its_definition():
    rng = np.random.default_rng(0)
    rows = [rng.choice(30, size=5, replace=False) for _ in range(200)]
    labels = [int(3 in r.tolist()) for r in rows]
    got = ftrl.train(rows, labels, 32, epochs=2, alpha=0.5, l1=0.1, l2=0.2)
    z, n = [0.0] * 32, [0.0] * 32

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.1 else -(z[i] - math.copysign(0.1, z[i])) / ((1 + math.sqrt(n[i])) / 0.5 + 0.2)
    for epoch in range(2):
        for k in np.random.default_rng(epoch).permutation(200):
            on = [*rows[k].tolist(), 31]
            w = [weight(i) for i in on]
            g = 1 / (1 + math.exp(-sum(w))) - labels[k]
            for i, x in zip(on, w):
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * x
                n[i] += g * g
    assert np.allclose(got, [weight(i) for i in range(32)], atol=1e-6)
    assert (ftrl.train([], [], 8) == 0).all()


def test_disguised_words_are_restored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = toxicity.Restorer(toxicity.trigram_costs(docs))
    for raw, word in [("1d10t", "idiot"), ("id1ot", "idiot"), ("i.d.i.o.t", "idiot"), ("IDIOTTTT!!!", "idiot"), ("m0r0n,", "moron"),
                      ("s-c-u-m", "scum"), ("$tup1d", "stupid"), ("cl0wn", "clown"), ("The", "the"), ("12345", "12345"), ("tree.", "tree")]:
        assert r.word(raw) == word
    assert r.text("such an i d i o t and a m0r0n") == "such an idiot and a moron"
    texts = spark.createDataFrame([(1, "an i d i o t"), (2, None), (None, "")], "doc_id long, text string")
    assert sorted(((x.doc_id, x.restored) for x in toxicity.restore(texts, toxicity.trigram_costs(docs)).collect()), key=repr) == [
        (1, "an idiot"), (2, ""), (None, "")]


def test_disguised_and_plain_words_have_the_same_features(spark):
    import types

    costs = toxicity.trigram_costs(spark.read.parquet(f"{SF}/documents.parquet"))
    features = toxicity.features_of(types.SimpleNamespace(value=costs), "test")
    (_, doc, found, n), = features(pa.array(["you idiot here", "you 1d10t here", "you i d i o t here", None]))
    sets = [set(found[doc == k].tolist()) for k in range(n)]
    assert sets[0] == sets[1] == sets[2] and not sets[3]


def test_viterbi_finds_the_cheapest_path(spark):
    """Against all readings of a lattice."""
    costs = toxicity.trigram_costs(spark.read.parquet(f"{SF}/documents.parquet"))
    r = toxicity.Restorer(costs)
    flat, letter = np.frombuffer(costs, dtype=np.float32), language._tables()[0]

    def readings(raw):
        out = [("", 0.0, False)]
        for i, x in enumerate(raw):
            more = []
            for text, cost, leaving in out:
                if x.isalpha():
                    more.append((text + x, cost, False))
                else:
                    more += [(text + y, cost + toxicity.COST_SIGN, False) for y in toxicity.SIGNS.get(x, "")]
                    more.append((text, cost + (toxicity.COST_DROP if x in toxicity.SIGNS or x.isalnum() else toxicity.COST_MARK), leaving))
                if i and raw[i - 1] == x and (text or leaving):
                    more.append((text, cost + (toxicity.COST_MORE if leaving else toxicity.COST_REPEAT), True))
            out = more
        return out

    def cost_of(text):
        at = [0, 0, *(int(letter[ord(c)]) for c in text), 0]
        L = language.LETTERS
        return sum(float(flat[(a * L + b) * L + c]) for a, b, c in zip(at, at[1:], at[2:]))
    for raw in ("h3ll0", "b00k", "tt1m3", "a.b1e", "8eee"):
        best = min((c + cost_of(t), t) for t, c, _ in readings(raw))
        assert r.decoded(raw) == best[1]


def test_license_scan_odd_rows(spark, odd_docs, no_docs):
    templates = license_scan.template_table(spark, {"short": "a b", "twelve": "one two three four five six seven eight nine ten eleven twelve", "none": "!!"})
    got = {(r.doc_id, r.template): (r.shared, r.shingles) for r in license_scan.license_scan(odd_docs, templates).collect()}
    assert got == {(1, "twelve"): (8, 8), (2, "twelve"): (8, 8), (3, "twelve"): (8, 8), (None, "twelve"): (8, 8),
                   (7, "short"): (1, 1), (8, "short"): (1, 1)}
    assert license_scan.license_scan(no_docs, templates).collect() == []
    assert license_scan.license_scan(odd_docs, templates.limit(0)).collect() == []


def test_license_scan_finds_parts_in_long_texts(spark):
    mit = license_scan.TEMPLATES["MIT-text"].split()
    filler = [f"w{k}" for k in range(3000)]
    rows = [(k, " ".join(filler[:37 * k] + mit[:cut] + filler[37 * k:])) for k, cut in enumerate([len(mit), 17, 10, 18])]
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), license_scan.template_table(spark)).collect()
    n = len(mit) - 4
    assert {r.doc_id: r.shared for r in found if r.template == "MIT-text"} == {
        k: cut - 4 for k, cut in enumerate([len(mit), 17, 10, 18]) if 100 * (cut - 4) >= 75 * n}


def test_license_scan_finds_short_templates_in_long_texts(spark):
    templates = license_scan.template_table(spark, license_scan.TEMPLATES | {
        "spdx": "SPDX-License-Identifier: MIT", "one": "copyleft"})
    filler = [f"w{k}" for k in range(300)]
    texts = ["SPDX-License-Identifier: MIT", "# spdx license identifier: mit", "(c) ALL rights, reserved", "all rights are reserved",
             "all rights", "Released under the MIT License. All rights reserved.", "Copyleft"]
    rows = [(k, text) for k, text in enumerate(texts)] + [
        (10 + k, " ".join([*filler[:37 * k], text, *filler[37 * k:]])) for k, text in enumerate(texts)]
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()
    held = [(0, "spdx"), (1, "spdx"), (2, "All-rights-reserved"), (5, "MIT"), (5, "All-rights-reserved"), (6, "one")]
    assert sorted((r.doc_id, r.template, r.shared, r.shingles) for r in found) == sorted(
        (k + more, name, 1, 1) for k, name in held for more in (0, 10))


def test_spelt_runs_are_parted_into_words(spark):
    import types

    costs = toxicity.trigram_costs(spark.read.parquet(f"{SF}/documents.parquet"))
    r = toxicity.Restorer(costs)
    features = toxicity.features_of(types.SimpleNamespace(value=costs), "spelt")
    for raw, text in [("such a m o r o n here", "such a moron here"), ("I s c u m", "i scum"), ("y o u i d i o t", "you idiot"),
                      ("s t u p i d m o r o n", "stupid moron"), ("i . d . i . o . t", "idiot"), ("m 0 r o n i d 1 o t", "moron idiot"),
                      ("i d i i o t", "idiot"), ("c l o w n", "clown")]:
        assert r.text(raw) == text
        (_, doc, found, n), = features(pa.array([raw, text]))
        assert set(found[doc == 0].tolist()) == set(found[doc == 1].tolist())
    assert r.text("a - b") == "a b" and r.text(" ".join("x" * 5000)).strip("x ") == ""


def test_doubled_letters_are_left_out(spark):
    r = toxicity.Restorer(toxicity.trigram_costs(spark.read.parquet(f"{SF}/documents.parquet")))
    for raw, word in [("stuupid", "stupid"), ("mooron", "moron"), ("Idiiot!", "idiot"), ("sccum", "scum"), ("ssttuuppiidd", "stupid"),
                      ("tree", "tree"), ("worthless", "worthless"), ("beer", "beer"), ("qqxx", "qqxx")]:
        assert r.word(raw) == word


def test_words_of_many_signs_have_the_cheapest_path():
    """Also if only the word's end makes it the cheapest."""
    L, letter, raw = language.LETTERS, language._tables()[0], "0123456+(1"
    costs = (np.random.default_rng(0).random((L, L, L)) * 20).astype(np.float32)
    paths = [(0.0, 0, 0, "")]
    for x in raw:
        paths = [(c + toxicity.COST_SIGN + costs[a, b, letter[ord(y)]].item(), b, letter[ord(y)], t + y)
                 for c, a, b, t in paths for y in toxicity.SIGNS[x]] + [(c + toxicity.COST_DROP, a, b, t) for c, a, b, t in paths]
    best = {}
    for c, a, b, t in paths:
        best[a, b] = min(best.get((a, b), (c, t)), (c, t))
    assert len(best) > 64
    end = max(best, key=best.get)
    costs[:, :, 0] = 10_000
    costs[end][0] = 0
    assert toxicity.Restorer(costs.tobytes()).decoded(raw) == best[end][1]


def _toxic_features(texts):
    from types import SimpleNamespace
    from revdrift.llm.language import LETTERS
    from revdrift.llm.toxicity import features_of

    return list(features_of(SimpleNamespace(value=bytes(4 * LETTERS ** 3)), "a test's costs")(texts))


def _stages():
    from revdrift.llm.exact_dedup import _collapse
    from revdrift.llm.packing import _placer
    from revdrift.llm.toxicity import _counts, _words

    return {"counts": lambda: list(_counts([])), "words": lambda: list(_words([])), "features": lambda: _toxic_features(pa.array(["a word"])),
            "collapse": lambda: list(_collapse([])), "placer": lambda: list(_placer([({3: 1}, 1)])([]))}


@pytest.mark.parametrize("stage", sorted(_stages()))
def test_a_stage_drops_what_earlier_stages_left_in_a_worker(stage):
    from revdrift.llm.common import forget, per_worker

    forget()
    old = per_worker("of an earlier stage", list)
    _stages()[stage]()
    assert per_worker("of an earlier stage", list) is not old


def test_toxicity_keeps_its_restorer_from_batch_to_batch():
    from revdrift.llm.common import per_worker

    _toxic_features(pa.array(["a word"]))
    kept = per_worker(("restorer", "a test's costs"), lambda: None)
    _toxic_features(pa.array(["an other word"]))
    assert kept is not None and per_worker(("restorer", "a test's costs"), lambda: None) is kept


def test_a_small_worker_is_left_behind_when_the_batches_end():
    from revdrift.llm.common import forget, per_worker, then_forget

    def run(batches):
        for b in batches:
            held = [per_worker("dropped", list), per_worker("kept", list)]
            yield b, held

    forget()
    (one, held), (two, same) = then_forget(run, "kept")([1, 2])
    assert (one, two) == (1, 2) and held[0] is same[0] and held[1] is same[1]
    assert per_worker("kept", list) is held[1] and per_worker("dropped", list) is not held[0]
