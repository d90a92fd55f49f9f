"""Near-duplicate documents by circulant MinHash, banding and exact checks.

Two permutations make all signature coordinates: one sends a shingle to a place
on a circle, the other gives every place a rank, and coordinate k is the least
rank k places further on, over the document's shingles.  A shingle's ranks for
all coordinates lie side by side in the table of the second permutation.

Documents with the same words are one class with one representative.  Classes
that agree in a band share a bucket.  Each is checked on full shingle sets
against the least of its bucket, which joins large groups without listing their
pairs; what a bucket still holds in several components is compared in blocks,
exactly, and only the links that join components leave a block.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, forget, per_worker, then_forget, written
from .components import components
from .wordgrams import slices

SHINGLE = 5
#: A pair that is just similar enough (0.75) shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS = 32, 4
#: Places of the circle.
CIRCLE = 1 << 22
#: Shingles and members of a block of a bucket, about.
BLOCK, MEMBERS = 1 << 18, 1024


def _word(word: str) -> tuple[int]:
    return (xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")),)


def _mix(x):
    import numpy as np

    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _odd(n: int, seed: int):
    import numpy as np

    return np.random.default_rng(seed).integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts):
    """Runs of rows: (first row, words' documents, words, shingles' documents,
    shingles, rows); 64-bit numbers, repeats included.  Documents with fewer
    words than a shingle have one: their whole sequence."""
    import numpy as np

    by = _odd(SHINGLE, 11)
    for row, doc, words, n in slices(texts, _word, 1, ascii_only=True):
        w = words[:, 0]
        count = np.bincount(doc, minlength=n)
        last = len(w) - SHINGLE + 1
        if last > 0:
            h = w[:last] * by[0]
            for k in range(1, SHINGLE):
                h = h + w[k:last + k] * by[k]
            whole = doc[:last] == doc[SHINGLE - 1:]
            of, h = doc[:last][whole], _mix(h[whole])
        else:
            of, h = np.empty(0, np.int64), np.empty(0, np.uint64)
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        if len(short):
            begins = np.cumsum(count) - count
            alone = [_mix((w[begins[d]:begins[d] + count[d]] * by[:count[d]]).sum(dtype=np.uint64, keepdims=True) + np.uint64(count[d]))[0] for d in short]
            of, h = np.concatenate([of, short]), np.concatenate([h, np.array(alone, dtype=np.uint64)])
            order = np.argsort(of, kind="stable")
            of, h = of[order], h[order]
        yield row, doc, w, of, h, n


def _ranks():
    """The second permutation, as windows of one rank for each coordinate."""
    import numpy as np

    def build():
        ranks = np.random.default_rng(12).permutation(CIRCLE).astype(np.uint32)
        return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:BANDS * ROWS]]), BANDS * ROWS)
    return per_worker("ranks", build)


def signatures(of, h, n: int):
    """Rows x coordinates of least ranks, for shingles ordered by document."""
    import numpy as np

    windows = _ranks()
    place = (_mix(h ^ np.uint64(0x5DEECE66D)) >> np.uint64(64 - 22)).astype(np.int64)
    least = np.full((n, BANDS * ROWS), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(place), 4096):
        part, own = windows[place[at:at + 4096]], of[at:at + 4096]
        edge = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own))
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
            np.minimum(least[own[i]], part[i:j].min(axis=0), out=least[own[i]])
    return least


def distinct(of, h, n: int):
    """(numbers, how many of each document) of the distinct shingles, sorted in each document."""
    import numpy as np

    edge = np.append(np.searchsorted(of, np.arange(n)), len(of))
    size, parts = np.zeros(n, dtype=np.int64), []
    for d, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
        if j > i:
            x = np.sort(h[i:j])
            parts.append(x[np.append(True, x[1:] != x[:-1])])
            size[d] = len(parts[-1])
    return np.concatenate([np.empty(0, np.uint64), *parts]), size


def _signed(batches):
    """[doc_id, text] -> [doc_id, words (128-bit hash), n_shingles, bands]."""
    import numpy as np
    import pyarrow as pa

    salt, by = _odd(BANDS, 13), _odd(ROWS, 14)
    forget("ranks")
    for b in batches:
        for row, doc, w, of, h, n in shingles(b.column(1)):
            count = np.bincount(doc, minlength=n)
            begins = np.cumsum(count) - count
            place = (np.arange(len(w)) - begins[doc]).astype(np.uint64)
            full = np.flatnonzero(count > 0)
            sums = [np.add.reduceat(_mix(w + _mix(place + np.uint64(s))), begins[full], dtype=np.uint64) if len(full) else
                    np.empty(0, np.uint64) for s in (1 << 40, 1 << 41)]
            _, size = distinct(of, h, n)
            least = signatures(of, h, n)[full].astype(np.uint64).reshape(len(full), ROWS, BANDS)
            bands = _mix((least * by[None, :, None]).sum(axis=1, dtype=np.uint64) + salt[None, :])
            words = [None] * n
            for k, d in enumerate(full.tolist()):
                words[d] = int(sums[0][k]).to_bytes(8, "big") + int(sums[1][k]).to_bytes(8, "big")
            offsets = np.append(0, np.cumsum(np.where(count > 0, BANDS, 0))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(row, n), pa.array(words, pa.binary()), pa.array(size),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1).view(np.int64)))],
                names=["doc_id", "words", "n_shingles", "bands"])


def _sets(batches):
    """[node, text] -> [node, n, shingles] with sorted distinct shingles."""
    import numpy as np
    import pyarrow as pa

    forget()
    for b in batches:
        for row, _, _, of, h, n in shingles(b.column(1)):
            h, size = distinct(of, h, n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(row, n), pa.array(size),
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(h.view(np.int64)))],
                names=["node", "n", "shingles"])


def _joining_links(percent: int):
    """Members of two blocks of a bucket -> links between components, each of
    which joins two that the ones before left apart."""
    def run(table):
        import numpy as np
        import pyarrow as pa

        node, comp = table["node"].to_numpy(), table["component"].to_numpy()
        lists = table["shingles"].combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        values = lists.values.to_numpy()[lists.offsets.to_numpy()[0]:]
        of = np.repeat(np.arange(len(node)), size)
        _, column, often = np.unique(values, return_inverse=True, return_counts=True)
        common = (often > 1)[column]
        of, column = of[common], (np.cumsum(often > 1) - 1)[column[common]]
        order = np.argsort(column, kind="stable")
        of, column = of[order], column[order]
        both = np.zeros((len(node), len(node)), dtype=np.float32)
        step = max(256, (1 << 21) // max(1, len(node)))
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            i, j = np.searchsorted(column, [at, at + step])
            x = np.zeros((len(node), step), dtype=np.float32)
            x[of[i:j], column[i:j] - at] = 1
            both += x @ x.T  # exact: counts below 2**24
        parent = {c: c for c in comp.tolist()}

        def top(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c
        a, b = [], []
        for at in range(0, len(node), 256):
            close = (100 + percent) * both[at:at + 256].astype(np.int64) >= percent * (size[at:at + 256, None] + size[None, :])
            close &= comp[at:at + 256, None] != comp[None, :]
            for i, j in zip(*np.nonzero(close)):
                x, y = top(int(comp[at + i])), top(int(comp[j]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a.append(int(node[at + i]))
                    b.append(int(node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs [a, b] whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    near = pairs.join(one, "a").join(two, "b").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    both = near.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("i"))
    return both.filter(f"100 * i >= {percent} * (na + nb - i)").select("a", "b")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row for each row of ``docs``: [doc_id, n_shingles, component_id, kept].

    Documents link when their sets of five-word shingles (lower-cased A-Z,
    words parted by ASCII white space) have 100 * intersection >= ``percent`` *
    union; ``component_id`` is the least id that links reach, and the document
    of that id is kept.  Null and empty texts and texts without words have no
    shingles, link with nothing and are kept.  Rows with a null id link with
    nothing, have no component and are kept.  Rows that share an id are one
    node of the graph and share its component.  Texts count whole at any length
    (a longer one is worked off by itself, in memory in proportion to its words).  Other columns are ignored; an
    empty table gives no rows.
    """
    rows = bounded_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    signed = written(rows.mapInArrow(then_forget(_signed, "ranks"), "doc_id long, words binary, n_shingles long, bands array<long>"), "signatures")
    known = signed.filter("doc_id IS NOT NULL AND words IS NOT NULL")
    classes = written(known.groupBy("words").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "classes")
    bands = (known.join(classes.select("words", F.col("node").alias("doc_id")), ["words", "doc_id"])
             .select(F.col("doc_id").alias("node"), F.explode("bands").alias("band")))
    buckets = bands.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    members = written(bands.join(buckets, "band").filter("node != hub").select("band", "node", "hub"), "members")

    pairs = members.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    needed = members.select("node").unionByName(members.select(F.col("hub").alias("node"))).distinct()
    texts = rows.withColumnRenamed("doc_id", "node").join(needed, "node")
    sets = written(texts.mapInArrow(then_forget(_sets), "node long, n long, shingles array<long>"), "shingle-sets")
    star = components(_similar(pairs, sets, percent))

    # members that a bucket still holds in several components
    now = members.join(star, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = (now.join(sets.select("node", "n").groupBy("node").agg(F.max("n").alias("n")), "node").groupBy("band")
             .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.sum("n").alias("weight"),
                  F.count("*").alias("size"), *[F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"digest{k}") for k in (1, 2)])
             .filter("least != most"))
    once = Window.partitionBy("size", "weight", "digest1", "digest2").orderBy("band")  # buckets of the same members count once
    open_ = mixed.withColumn("k", F.row_number().over(once)).filter("k = 1").select(
        "band", F.ceil(F.greatest(F.col("weight") / BLOCK, F.col("size") / MEMBERS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocks = (now.join(open_, "band").select("band", "node", "component", own.alias("own"), other.alias("other"))
              .select("band", "node", "component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    more = written(blocks.join(sets.select("node", "shingles"), "node").groupBy("band", "x", "y")
                   .applyInArrow(_joining_links(percent), "a long, b long"), "links")
    if not more.isEmpty():
        star = components(more.unionByName(star.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    shared = (classes.join(star, "node", "left").filter("copies > 1 OR component != node")
              .select("words", F.coalesce("component", "node").alias("component")))
    out = signed.select("doc_id", "words", "n_shingles").join(shared, "words", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.cast("long").alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
