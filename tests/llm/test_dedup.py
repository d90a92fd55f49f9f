import collections
import hashlib

import numpy as np
import pytest

from brute import brute_near, reach, shingle_set
from revdrift.llm import embedding_dedup as E
from revdrift.llm import near_dedup as N
from revdrift.llm.components import components
from revdrift.llm.embedding_dedup import embedding_dedup
from revdrift.llm import exact_dedup as X
from revdrift.llm.exact_dedup import build_index, directory, exact_dedup, insert, keep_one, lookup, open_index, owners
from revdrift.llm.near_dedup import near_dedup


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_dedup_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert rows_of(near_dedup(docs)) == brute_near([(r.doc_id, r.text) for r in docs.collect()])


def test_near_dedup_odd_rows(odd_docs, no_docs):
    got = near_dedup(odd_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows_of(got) == brute_near([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert near_dedup(no_docs).collect() == []


def test_near_dedup_finds_links_that_miss_the_hub(spark, monkeypatch):
    """A chain of texts of which only neighbours are similar, in blocks of a few members."""
    monkeypatch.setattr(N, "MEMBERS", 4)
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 10 ** 6, size=900)]
    rows = [(int(k), " ".join(words[3 * k:3 * k + 100])) for k in rng.permutation(40)]
    rows += [(1000 + k, " ".join(words[600:700] + [f"z{k}"] * (20 + k % 3))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(near_dedup(docs)) == brute_near(rows)


def test_circulant_signatures_estimate_similarity():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 10 ** 6, size=600)]
    texts = [" ".join(base[:500]), " ".join(base[50:550])]
    (_, _, _, of, h, n), = N.shingles(pa.array(texts))
    a, b = N.signatures(of, h, n)
    x, y = map(shingle_set, texts)
    assert abs((a == b).mean() - len(x & y) / len(x | y)) < 0.12
    whole = [x.astype(np.uint64) for x in (a, b)]  # by the definition: ranks at each shift
    ranks = N._ranks()[:, 0]
    place = (N._mix(h[of == 0] ^ np.uint64(0x5DEECE66D)) >> np.uint64(42)).astype(np.int64)
    for k in (0, 1, 63, 127):
        assert whole[0][k] == ranks[(place + k) % N.CIRCLE].min()


def test_shingles_do_not_depend_on_batches(monkeypatch):
    import pyarrow as pa

    from revdrift.llm import wordgrams

    rng = np.random.default_rng(0)
    texts = [" ".join(f"ABcdé{x}" for x in rng.integers(0, 50, size=rng.integers(0, 40))) if k % 7 else None for k in range(300)]

    def run(array):
        return [sorted(h[of == d].tolist()) for _, _, _, of, h, n in N.shingles(array) for d in range(n)]
    whole = run(pa.array(texts))
    monkeypatch.setattr(wordgrams, "SLICE_BYTES", 1000)
    assert run(pa.array(texts)) == whole
    assert run(pa.array(["é ZZ " * 50] * 13 + texts).slice(13)) == whole


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(60)]
    star = [(100, k) for k in range(101, 150)] + [(100, 120), (120, 100)]
    got = components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 150)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- exact copies

def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=repr)


@pytest.mark.parametrize("index", [{}, {"key_bits": 3, "bucket_entries": 2, "max_depth": 6}, {"bucket_entries": 1, "max_depth": 4}])
def test_exact_dedup_with_collisions_and_full_buckets(odd_docs, no_docs, index):
    assert rows_of(exact_dedup(odd_docs, **index)) == brute_exact([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert exact_dedup(no_docs, **index).collect() == []


def test_keep_one_keeps_all_columns_of_one_row_for_each_text(odd_docs, no_docs):
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    best = {}
    for r in odd_docs.collect():
        best[r.text or ""] = max(best.get(r.text or "", -1), -1 if r.doc_id is None else r.doc_id)
    assert sorted((r.text or "", r.doc_id) for r in kept.collect()) == sorted(best.items())
    assert keep_one(no_docs).collect() == []


def test_directory_doubles_for_overfull_buckets():
    assert directory({}, 2, 4) == (0, [0])
    depth, slots = directory({0b0000: 2, 0b0001: 2, 0b1000: 1}, 2, 4)
    assert depth == 4 and len(slots) == 16
    assert slots[0] != slots[1] and len(set(slots[8:])) == 1  # only the full half was split
    assert slots == sorted(slots)
    assert directory({3: 100}, 1, 2) == (2, [0, 0, 1, 2])  # as deep as it goes, then it chains


def entries_of(rows):
    """text -> (largest id, rows), by definition."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max(g), len(g)) for t, g in groups.items()}


def test_a_second_batch_doubles_the_directory(spark):
    first = [(k, f"text {k % 37} " * (k % 5)) for k in range(120)]
    second = [(1000 + k, f"text {k % 301} " * (k % 7)) for k in range(900)]
    schema = "doc_id long, text string"
    one = build_index(spark.createDataFrame(first, schema), bucket_entries=16, max_depth=8, key_bits=10)
    two = insert(open_index(spark, one.path), spark.createDataFrame(second, schema).repartition(3))
    assert 0 < one.depth < two.depth
    for index, rows in ((one, first), (two, first + second)):
        again = open_index(spark, index.path)
        held = again.entries.collect()
        assert {r.text: (r.keep_id, r.group_size) for r in held} == entries_of(rows) and len(held) == len(entries_of(rows))
        place = {r.slot: r.bucket for r in again.directory.collect()}
        assert len(place) == 2 ** again.depth
        assert all(r.bucket == place[(r.key & (2 ** 64 - 1)) >> (64 - again.depth)] for r in held)
        chains = collections.defaultdict(list)
        for r in held:
            chains[r.key].append(r.chain)
        assert all(sorted(c) == list(range(len(c))) for c in chains.values())
        in_file = {(r.bucket, r.f) for r in again.entries.select("bucket", X.F.input_file_name().alias("f")).distinct().collect()}
        assert len(in_file) == len({b for b, _ in in_file})  # a bucket lies in one file
    assert any(len(c) > 1 for c in chains.values())  # ten bits collide

    asked = spark.createDataFrame([(1, first[3][1]), (2, "never seen"), (3, None), (4, second[8][1])], schema)
    want = entries_of(first + second)
    assert {r.doc_id: (r.keep_id, r.group_size) for r in lookup(two, asked).collect()} == {
        1: want[first[3][1]], 2: (None, None), 3: want[""], 4: want[second[8][1]]}
    assert {r.doc_id: r.group_size for r in lookup(one, asked).collect()}[4] is None


def test_buckets_and_owners_are_bounded_by_bytes(spark):
    rows = [(k, f"{k} " * 2000) for k in range(64)] + [(k, str(k)) for k in range(64, 128)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = build_index(docs, bucket_bytes=40_000, max_depth=10)
    held = collections.defaultdict(list)
    for r in index.entries.collect():
        held[r.bucket].append(r.n_bytes)
    assert len(held) > 8 and all(sum(b) <= 40_000 for b in held.values())
    assert rows_of(exact_dedup(docs, bucket_bytes=100)) == brute_exact(rows)  # one text alone may be larger
    assert owners([10, 10, 10, 10], 2) == [0, 0, 1, 1]
    got = owners([100] * 50 + [10_000] + [100] * 50, 8)
    assert got == sorted(got) and max(got) < 8 and got.count(got[50]) < 55


def test_texts_that_most_rows_share_are_merged_by_salted_groups(spark, monkeypatch):
    monkeypatch.setattr(X, "SALTS", 3)
    rows = [(k, "the same text" if k % 3 else f"rare {k % 40}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for one_in in (1, 10, 10_000):  # none, one and all texts are common
        monkeypatch.setattr(X, "HOT_ONE_IN", one_in)
        assert rows_of(exact_dedup(docs, key_bits=2)) == brute_exact(rows)


# ---------------------------------------------------------------- embeddings

def brute_embeddings(rows, cosine=0.95):
    unit = {}
    for k, (i, v) in enumerate(rows):
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float64)
        unit[k] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    pairs = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]
    links = collections.Counter(k for p in pairs for k in p)
    ids = [i for i, _ in rows if i is not None]
    least = reach(ids, [(rows[a][0], rows[b][0]) for a, b in pairs])
    return sorted(((i, links[k], None if i is None else least[i], i is None or i == least[i]) for k, (i, _) in enumerate(rows)), key=repr)


def test_embedding_dedup_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [2.0, 0.0, 0.0]), (4, [0.0, 0.0, 0.0]), (5, [0.0, 0.0, 0.0]), (6, None),
            (7, []), (8, [nan, 1.0, 0.0]), (9, [nan, 1.0, 0.0]), (10, [inf, 0.0, 0.0]), (11, [1.0, None, 0.0]), (12, [1.0, 0.0]),
            (13, [1.0, 0.0]), (14, [-1.0, 0.0, 0.0]), (15, [1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (16, [1e-200, 0.0, 0.0]), (17, [5.0]), (18, [3.0])]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n_links int, node string")
    assert rows_of(embedding_dedup(vectors)) == brute_embeddings(rows)
    assert embedding_dedup(vectors.limit(0)).collect() == []


def test_embedding_dedup_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    near = np.concatenate([centres[k % 3] + 0.05 * rng.normal(size=24)[None] for k in range(120)])
    x = np.concatenate([near, centres, rng.normal(size=(100, 24)), near[:30]]).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got, want = rows_of(embedding_dedup(vectors)), brute_embeddings(rows)
    assert sum(r[1] for r in got) >= 0.9999 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert [g[2:] for g in got] == [w[2:] for w in want]


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(E.hadamard(x), axis=1), 4 * np.linalg.norm(x, axis=1))
    assert np.allclose(E.hadamard(E.hadamard(x)), 16 * x)
