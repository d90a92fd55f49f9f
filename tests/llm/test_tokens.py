import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from revdrift.llm import queries as Q
from revdrift.llm.blocks import LibraryCoder, encode_texts
from revdrift.llm.packing import best_fit, pack, plan_sequences
from revdrift.llm.prefix_bpe import Prefixes, decode, encode, load
from revdrift.llm.token_files import read_tokens, with_crc32, write_tokens

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def documents(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def test_token_files_hold_the_librarys_ids_in_order(spark, small, library):
    start = 0
    texts = documents(spark, small)
    got = {r.doc_id: r for r in Q.op2_token_files(spark, small).collect()}
    for i in sorted(texts):
        ids = library(texts[i]) + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == len(texts)


def test_token_files_odd_rows(spark, odd_docs, no_docs, library, tmp_path):
    folder = write_tokens(odd_docs, JSON, out=str(tmp_path / "t"), end_id=None)
    rows = read_tokens(spark, folder).orderBy("start", "n_tokens").collect()
    want = [(r.doc_id, library(r.text)) for r in odd_docs.collect()]
    assert sorted(((r.doc_id, r.ids) for r in rows), key=repr) == sorted(want, key=repr)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows if r.n_tokens]
    assert ids == sorted(ids)
    some = read_tokens(spark, folder, 7, 9)
    assert sorted(r.doc_id for r in some.collect()) == [7, 7, 8, 9]
    assert read_tokens(spark, write_tokens(no_docs, JSON)).collect() == []


def test_token_files_layout(spark, small, tmp_path):
    folder = tmp_path / "t"
    write_tokens(spark.read.parquet(f"{small}/documents.parquet"), JSON, out=str(folder))
    column = pq.ParquetFile(max(folder.glob("*.parquet"), key=lambda p: p.stat().st_size)).metadata.row_group(0)
    by = {column.column(i).path_in_schema: column.column(i) for i in range(column.num_columns)}
    assert "RLE_DICTIONARY" in by["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in by["place"].encodings
    assert all(c.has_offset_index for c in by.values())
    plan = read_tokens(spark, str(folder), 5, 9).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan and "ids:array" not in plan.split("== Physical Plan ==")[1]


def test_prefix_bpe_equals_the_definition(spark, odd_docs, no_docs, small, reference):
    tokens = encode(odd_docs, RANKS, P.PATTERN)
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in decode(tokens, RANKS).collect()), key=repr)
    assert got == sorted(((r.doc_id, reference(r.text or ""), (r.text or "").encode()) for r in odd_docs.collect()), key=repr)
    assert encode(no_docs, RANKS, P.PATTERN).collect() == []
    texts = documents(spark, small)
    for r in Q.op3_prefix_bpe(spark, small).collect():
        ids = reference(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_prefix_tables_append_and_change():
    bpe = load(RANKS)
    rng = random.Random(4)
    letters = b"aeinorst theXY.0"
    for _ in range(60):
        data = bytes(rng.choices(letters, k=rng.randint(0, 40)))
        table = Prefixes(bpe, data[:7])
        table.append(data[7:])
        for n in range(len(data) + 1):
            assert table.ids(n) == bpe.merged(data[:n])
        i, j = sorted((rng.randint(0, len(data)), rng.randint(0, len(data))))
        new = bytes(rng.choices(letters, k=rng.randint(0, 5)))
        table.replace(i, j, new)
        assert table.data == data[:i] + new + data[j:] and table.ids() == bpe.merged(table.data)
    long = Prefixes(bpe, b"abcdefgh tion " * 2000)
    assert long.replace(50, 52, b"zz") < 1000  # only near the edit
    assert long.ids() == Prefixes(bpe, long.data).ids()


def check_packing(rows, texts, library, capacity, end_id):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_doc) == sorted(texts)
    for i, text in texts.items():
        ids, at = library(text) + [end_id], 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_packing_is_gapless_and_tight(spark, small, library):
    texts = documents(spark, small)
    rows = Q.op6_packing(spark, small).collect()
    n = check_packing(rows, texts, library, 1024, 2)
    assert n <= 1.02 * sum(r.length for r in rows) / 1024 + 1


def test_packing_odd_rows(spark, odd_docs, no_docs, library):
    texts = {k: r.text for k, r in enumerate(odd_docs.collect())}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    p = pack(docs, JSON, capacity=64)
    check_packing(p.placed.join(with_crc32(p.pieces), ["part", "row"]).collect(), texts, library, 64, 2)
    sizes = [len(r.ids) for r in p.sequences().collect()]
    assert max(sizes) <= 64 and sum(sizes) == sum(len(library(t)) + 1 for t in texts.values())
    assert pack(odd_docs, JSON).placed.count() >= odd_docs.count()
    assert pack(no_docs, JSON).placed.collect() == []


def test_plans_hold_all_pieces_and_few_sequences():
    rng = np.random.default_rng(2)
    for n, capacity in ((0, 8), (1, 8), (50, 20), (4000, 100), (60_000, 128)):
        lengths = np.minimum(capacity, rng.geometric(3 / capacity, size=n) + rng.integers(0, 4, size=n))
        counts = dict(collections.Counter(lengths.tolist()))
        plan, held = plan_sequences(counts, capacity), collections.Counter()
        for content, copies in plan:
            assert sum(x * a for x, a in content.items()) <= capacity
            for x, a in content.items():
                held[x] += a * copies
        assert held == counts
        greedy = sum(k for _, k in best_fit(dict(counts), [], capacity))
        assert sum(k for _, k in plan) <= 1.005 * greedy + 2


def test_packing_drops_what_earlier_stages_left_in_a_worker(monkeypatch):
    from pyspark import TaskContext
    from revdrift.llm.common import per_worker
    from revdrift.llm.packing import _cutter

    class First:
        def partitionId(self):
            return 0
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: First()))
    old = per_worker("of an earlier stage", list)
    assert list(_cutter("a path", 1024, 2, False)([])) == []
    assert per_worker("of an earlier stage", list) is not old


def coded(texts, coder):
    return [ids[i:j].tolist() for _, ids, at in encode_texts(pa.array(texts, pa.string()), coder) for i, j in zip(at[:-1], at[1:])]


def test_the_library_gets_a_stem_once_whatever_marks_follow_it(library):
    coder, got = LibraryCoder(JSON, False), []
    whole = coder.whole
    coder.whole = lambda texts: got.extend(texts) or whole(texts)
    stems = [f"stemof{i}" for i in range(300)]
    texts = ["a " + " ".join(s + marks for s in stems) for marks in ("", ".", ",", "!?", "$$$", ").", ".")]
    assert coded(texts, coder) == [library(t) for t in texts]
    assert sum(map(len, got)) < 2 * len(" ".join(stems))


def test_ids_of_blocks_with_marks_and_white_space_are_the_librarys(library):
    coder, rng = LibraryCoder(JSON, False), random.Random(8)
    parts = ["word", "Other", "7", "42", "caf\u00e9", "e\u0301", "\u65e5\u672c", "\u0661", "\U0001f600", "\u2026", "'", "'s", "'re", "\u2019", "_", "-",
             ".", ",", "!?", "$$$", ").", "<|endoftext|>", "<|", " ", " ", " ", " ", "  ", "\n", ".\n", "\t", "\x0b", "\x1f", "\x85", "\xa0", "\u3000", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)] + ["a\x0b \x0bb", "end. ", "end.\n", " .", None, ""]
    want = [library(t) for t in texts]
    assert coded(texts, coder) == want
    assert coded(texts, coder) == want  # by what is known
    assert [i for t in texts for i in coded([t], coder)] == want


def test_marks_that_a_vocabulary_joins_to_letters_stay_with_them(tmp_path):
    vocab = {c: i for i, c in enumerate(sorted(pre_tokenizers.ByteLevel.alphabet()))}
    merges = [("a", "."), ("\u0120", "a"), ("a.", ".")]
    for x, y in merges:
        vocab.setdefault(x + y, len(vocab))
    t = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    t.save(str(tmp_path / "t.json"))
    texts = ["b a. a.. xa.", "a a b", "a, a. a"]
    assert coded(texts, LibraryCoder(str(tmp_path / "t.json"), False)) == [t.encode(x).ids for x in texts]


def test_token_files_and_packing_take_a_stem_to_the_library_once_in_a_task(monkeypatch, library):
    from pyspark import TaskContext
    from revdrift.llm import packing, token_files

    class First:
        def partitionId(self):
            return 0
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: First()))
    stems = [f"{i}taskof" for i in range(300)]
    texts = ["a " + " ".join(s + marks for s in stems) for marks in (",", ".", "", ";", "...", '."')]
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], names=["doc_id", "text"]) for i, t in enumerate(texts)]
    for run, module in ((token_files._encoder(JSON, 0, False), token_files), (packing._cutter(JSON, 1 << 20, 0, False), packing)):
        coder, got = LibraryCoder(JSON, False), []
        whole = coder.whole
        coder.whole = lambda texts: got.extend(texts) or whole(texts)
        monkeypatch.setattr(module, "library_coder", lambda *_: coder)
        assert [ids for b in run(iter(batches)) for ids in b.column("ids").to_pylist()] == [library(t) + [0] for t in texts]
        assert sum(map(len, got)) < 2 * len(" ".join(stems))
