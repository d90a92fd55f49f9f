"""Periodic runs, whitening and fingerprints against their definitions."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from revdrift.llm import fingerprints as S
from revdrift.llm import queries as Q
from revdrift.llm import whitening as W
from revdrift.llm.periodic_runs import periodic_runs, runs_in, runs_of
from revdrift.llm.suffix_tree import Least, Tree


def brute_runs(x, least):
    """All maximal stretches of each distance, without those of a smaller period."""
    out, n = [], len(x)
    for q in range(1, n):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and x[e] == x[e + q]:
                e += 1
            length = e + q - s
            if e > s and length >= max(least, 2 * q) and not any(
                    all(x[t] == x[t + d] for t in range(s, s + length - d)) for d in range(1, q)):
                out.append((s, length, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(seed, many, longest=50):
    rng = random.Random(seed)
    for _ in range(many):
        n, k = rng.randint(0, longest), rng.choice([1, 2, 2, 3, 5])
        x = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.6 and n > 4:
            p = rng.randint(1, n // 2)
            x = [x[i % p] for i in range(n)]
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(n)] = rng.randrange(k)
        yield x


def test_suffix_tree_extensions_and_ranks():
    for x in sequences(1, 150, 40):
        tree, n = Tree(np.array(x, dtype=np.int64) + 1), len(x)
        suffixes = [x[i:] for i in range(n + 1)]
        order = sorted(range(n + 1), key=lambda i: suffixes[i])
        assert np.argsort(tree.ranks()).tolist() == order
        falling = sorted(range(n + 1), key=lambda i: [-v for v in suffixes[i]])
        assert np.argsort(tree.ranks(falling=True)).tolist() == falling
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        if pairs:
            i, j = np.array(pairs).T
            want = [next((k for k, (a, b) in enumerate(zip(suffixes[p], suffixes[q])) if a != b), min(n - p, n - q)) for p, q in pairs]
            assert tree.extension(i, j).tolist() == want


def test_least_entries_of_long_arrays():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1000, 5000)
    least = Least(values)
    i = rng.integers(0, 5000, 3000)
    j = np.minimum(i + rng.integers(0, 4000, 3000) // rng.choice([1, 100, 1000], 3000), 4999)
    assert least(i, j).tolist() == [values[a:b + 1].min() for a, b in zip(i, j)]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    texts = list(sequences(3, 400))
    for x in texts:
        assert [tuple(r) for r in runs_of(np.array(x, dtype=np.int64), least).tolist()] == brute_runs(x, least)
    # many documents one behind the other; runs never reach over an edge
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    begins = np.cumsum([0] + [len(x) for x in texts])
    got = [(d, s - begins[d], n, q) for d, s, n, q in runs_in(np.array([v for x in texts for v in x]), doc, least).tolist()]
    assert got == [(d, *r) for d, x in enumerate(texts) for r in brute_runs(x, least)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_odd_rows(spark, odd_docs, no_docs):
    got = periodic_runs(odd_docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for r in odd_docs.collect():
        words = (r.text or "").encode().split()
        runs = [(0, 30_000, 1)] if len(words) >= 30_000 else brute_runs(words, 12)
        want.append((r.doc_id, len(words), runs, collapsed([w.decode() for w in words], runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert periodic_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(odd_docs, least=1)


def test_long_periodic_text(spark):
    """Half a million words of a long period and of one word."""
    text = " ".join(f"w{i % 9973}" for i in range(250_000)) + " x" * 250_000
    r = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(0, 250_000, 9973), (250_000, 250_000, 1)]
    assert len(r.collapsed.split()) == 9974


def test_runs_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = {}
    for d in docs:
        words = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 500:
            continue  # too slow by brute force; the SQL covers them
        runs = brute_runs(words, 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        want[d.doc_id] = (len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2],
                          hashlib.sha256(lines.encode()).hexdigest(),
                          hashlib.sha256(collapsed([w.decode() for w in words], runs).encode()).hexdigest())
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in Q.op11_periodic_runs(spark, small).collect()}
    assert len(want) > 100 and {k: got[k] for k in want} == want


# ---- whitening

def spectrum(values, seed=0):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (3 * np.eye(n, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values", [
    np.linspace(1, 100, 48), [1 + 1e-9 * k for k in range(12)] + [5 + 1e-11 * k for k in range(5)] + [30.0, 40.0],
    [1 + 1e-8 * k for k in range(40)], np.logspace(-6, 4, 30), [7.0], [1e-300, 3e-300]])
def test_refined_vectors_are_right_to_double_precision(values):
    a, q = spectrum(values)
    got, x = W.refined(a)
    order = np.argsort(-np.array(values))
    assert np.abs(got - np.array(values)[order]).max() <= 4e-16 * max(values)
    x = x.astype(np.longdouble)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15
    assert np.abs(a @ x - x * got).max() <= 1e-15 * max(values)
    assert np.abs(np.abs((q[:, order] * x).sum(axis=0)) - 1).max() < 1e-12  # float64 alone mixes the clusters


@pytest.mark.parametrize("values", [[3.0] * 9, [0.0] * 4, [0.0, 0.0, 1.0, 2.0, 2.0]])
def test_equal_eigenvalues_give_some_orthonormal_vectors(values):
    a, _ = spectrum(values)
    got, x = W.refined(a)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15
    assert np.abs(a @ x - x * got).max() < 1e-15


def grid(vector):
    return None if vector is None or any(c is None or not np.isfinite(c) for c in vector) else [
        int(np.floor(64 * float(c))) + 1_000_000 for c in vector]


def brute_whitening(rows, most=16):
    """(id, component) -> deviation, whitened up to sign, explained; from exact sums."""
    rows = [(i, x) for i, v in rows if (x := grid(v)) is not None]
    fit = sorted({tuple(x) for _, x in rows})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    t = np.array([[n * a - s for a, s in zip(x, total)] for x in fit], dtype=np.int64)
    c = t / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, x in rows:
        d = [n * a - s for a, s in zip(x, total)]
        white = (np.array(d) / n) @ u / np.sqrt(e)
        for k in range(min(most, len(e))):
            out[i, k + 1] = (n, sum(a * a for a in d), abs(white[k]), e[k] / e.sum())
    return out


def test_whitening_query_equals_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = brute_whitening(rows)
    got = Q.op12_whitening(spark, small).collect()
    assert Counter((r.vec_id, r.component) for r in got) == Counter(want.keys())
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(white, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-10)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-12


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(5)
    vectors = [(k, [float(c) for c in rng.normal(size=3)]) for k in range(40)]
    odd = [(40, vectors[0][1]), (40, vectors[0][1]), (41, None), (42, [1.0, None, 2.0]), (43, [1.0, float("nan"), 2.0]),
           (44, [float("inf"), 0.0, 0.0]), (None, vectors[1][1]), (45, []), (46, [1.0, 2.0]), (46, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 7, "c") for i, v in vectors + odd], "vec_id long, e array<float>, component int, x string")
    rows = df.select("vec_id", "component", W.quantised(F.col("e")).alias("q"))
    fitted = W.fit(rows, "q")
    assert sorted(fitted) == [2, 3]
    assert fitted[3].n == 40 and len(fitted[3].explained) == 3 and fitted[3].identity_error < 1e-12
    assert fitted[2].n == 1 and fitted[2].explained == ()  # one vector has no variance
    assert sum(map(Fraction, fitted[3].explained)) == pytest.approx(1)
    got = W.whiten(rows, fitted, "vec_id", "q")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids = Counter(r.vec_id for r in got.collect())
    assert ids == Counter({**{k: 3 for k in range(40)}, 40: 6, None: 3})
    none = rows.limit(0)
    assert W.fit(none, "q") == {} and W.whiten(none, {}, "vec_id", "q").collect() == []


def test_whitening_leaves_out_what_has_no_variance(spark):
    rows = spark.createDataFrame([(k, [k, 2 * k, 5]) for k in range(10)], "vec_id long, x array<long>")
    fitted = W.fit(rows)
    assert len(fitted[3].explained) == 1 and fitted[3].explained[0] == pytest.approx(1)
    white = [r.whitened for r in W.whiten(rows, fitted).orderBy("vec_id").collect()]
    assert np.mean(white) == pytest.approx(0, abs=1e-12) and np.var(white) == pytest.approx(1)


def test_deviations_beyond_a_long_are_an_error(spark):
    rows = spark.createDataFrame([(k, [k * 10 ** 10]) for k in range(3)], "vec_id long, x array<long>")
    with pytest.raises(Exception, match="(?i)overflow|too large|int"):
        W.whiten(rows, W.fit(rows)).collect()


# ---- fingerprints

def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    hashes = {hashlib.md5(s).hexdigest()[:12] for s in shingles}
    return sorted(h for h in hashes if h < "4" or h == min(hashes))


def brute_containment(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def test_fingerprints_odd_rows(spark, odd_docs, no_docs):
    got = S.fingerprints(odd_docs)
    assert got.columns == ["doc_id", "text", "fingerprint"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        ((r.doc_id, r.text or "", brute_fingerprint(r.text)) for r in odd_docs.collect()), key=repr)
    assert S.fingerprints(no_docs).collect() == [] and S.with_next(S.fingerprints(no_docs), "text").collect() == []


def test_next_rows_over_many_stretches(spark, monkeypatch):
    """Hot and null ids, one stretch and many."""
    rng = random.Random(4)
    ids = [rng.randrange(10 ** 6) for _ in range(300)] + [500_000] * 100 + [None] * 3 + [-5, 2 ** 62]
    rows = [(i, f"t{k:04}") for k, i in enumerate(ids)]
    rng.shuffle(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted(((*a, b[1]) for a, b in zip(order, order[1:] + order[:1])), key=repr)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for stretches in (1, 7):
        monkeypatch.setattr(S, "STRETCHES", stretches)
        assert sorted((tuple(r) for r in S.with_next(df, "text").collect()), key=repr) == want
    one = df.filter("doc_id = -5")
    assert [tuple(r) for r in S.with_next(one, "text").collect()] == [(-5, *[one.first().text] * 2)]


def test_fingerprint_query_odd_rows(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = map(brute_fingerprint, (text, edited, after))
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), brute_containment(a, b), brute_containment(a, c)))
    got = Q.op13_fingerprints(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_containment_of_very_unequal_documents(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    small = words[7000:8000]
    half = small[:500] + [f"z{k}" for k in range(500)]
    df = S.fingerprints(spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate((words, small, half))], "doc_id long, text string"))
    own = {r.doc_id: r.fingerprint for r in df.collect()}
    of = {k: brute_containment(own[k], own[0]) for k in (1, 2)}
    assert of[1] == 1 and abs(of[2] - 0.5) < 0.1 and brute_containment(own[0], own[1]) < 0.05
    # merged fingerprints are those of the union
    both = S.merged(df.filter("doc_id > 0").withColumn("shard", F.lit("s")), "shard")
    assert {r.hash for r in both.collect()} == set(own[1]) | set(own[2])
    got = {r.doc_id: r.containment for r in S.contained(df, both, "shard").collect()}
    assert got[1] == got[2] == 1 and got[0] == pytest.approx(brute_containment(own[0], set(own[1]) | set(own[2])))


def test_fingerprint_plan_is_native_and_shuffles_texts_once(spark, small):
    plan = Q.op13_fingerprints(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and plan.count("md5(") == 2
