"""Near-duplicate embeddings by cross-polytope hashing.

A hash turns the unit vector by three rounds of random signs and a fast
Hadamard transform and takes the coordinate of largest size with its sign: the
nearest vertex of a cross-polytope.  Some turned vectors make the bucket of a
table, and probing several buckets for a vector, those with the next largest
coordinates, makes near vectors meet in fewer tables.  Of buckets with the same
vectors (known by their number and 128 bits) one is enough.  Those are compared
in blocks by exact cosines: a pair counts in the least bucket that both are in, a
block gives each vector's number of links and only links that join components.
A vector travels as it came, with the numbers of its own buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import partitions, per_worker, written
from .components import components

#: Tables, turned vectors for each, buckets of a vector in a table.  Of pairs
#: with cosine 0.95 in 64 dimensions two thirds meet in any one table.
TABLES, TURNS, PROBES = 14, 3, 4
#: Vectors of a block of a bucket.
BLOCK = 1024
#: Vectors that are hashed together.
CHUNK = 512
#: Earlier buckets that a block's pairs are looked up in at a time.
COLUMNS = 2048


def hadamard(x):
    """The Walsh-Hadamard transform of the rows (a power of two of columns)."""
    import numpy as np

    rows, n = x.shape
    half = 1
    while half < n:
        y = x.reshape(rows, n // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return x


def buckets(unit):
    """Rows x (tables * probes) of 64-bit bucket numbers of unit vectors.

    The first probe of a table takes each turned vector's largest coordinate;
    the others replace one of them by the next largest, least loss first."""
    import numpy as np

    m, dims = unit.shape
    n = 1 << max(0, (dims - 1).bit_length())
    signs = per_worker(("turns", n), lambda: np.random.default_rng(n).choice([-1.0, 1.0], size=(TABLES, TURNS, 3, n)))
    padded = np.zeros((m, n))
    padded[:, :dims] = unit
    out = np.empty((m, TABLES, PROBES), dtype=np.int64)
    row = np.arange(m)
    for t in range(TABLES):
        best, second, loss = [], [], []
        for k in range(TURNS):
            x = padded
            for s in signs[t, k]:
                x = hadamard(x * s) / np.sqrt(n)
            size = np.abs(x)
            top = size.argmax(axis=1)
            most = size[row, top]
            size[row, top] = -1
            nxt = size.argmax(axis=1)
            best.append(2 * top + (x[row, top] < 0))
            second.append(2 * nxt + (x[row, nxt] < 0))
            loss.append(most - size[row, nxt])
        order = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")
        for p in range(PROBES):
            key = np.full(m, t, dtype=np.int64)
            for k in range(TURNS):
                other = (order[:, p - 1] == k) if 0 < p <= TURNS else np.zeros(m, dtype=bool)
                key = key * (2 * n) + np.where(other, second[k], best[k])
            out[:, t, p] = key
    return out.reshape(m, -1)


def _units(lists):
    """(rows, unit vectors) of an Arrow list column for each length of vector;
    rows that cannot link are left out.  Nulls inside become not a number."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.if_else(pc.is_valid(lists), lists, pa.scalar([], lists.type))
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(at)
    for n in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == n)
        x = flat[at[rows][:, None] + np.arange(n)]
        most = np.abs(x).max(axis=1)
        good = np.isfinite(x).all(axis=1) & (most > 0)
        rows, x = rows[good], x[good] / most[good][:, None]  # no square leaves the range
        if len(rows):
            yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _list(rows):
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.reshape(-1)))


def _hashed(batches):
    """[embedding, node, copies] -> the same with [buckets], without vectors that cannot link."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for rows, unit in _units(b.column(0)):
            keys = np.concatenate([buckets(unit[i:i + CHUNK]) for i in range(0, len(unit), CHUNK)])
            kept = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, _list(keys)], names=["embedding", "node", "copies", "buckets"])


def _met_before(at, values, bucket, left, right):
    """left x right members of a block: are both in a bucket before this one?
    ``values[at[k]:at[k + 1]]`` are the buckets of member k."""
    import numpy as np

    row, value = np.repeat(np.arange(len(at) - 1), np.diff(at)), values[at[0]:at[-1]]
    row, value = row[value < bucket], value[value < bucket]
    _, column, n = np.unique(value, return_inverse=True, return_counts=True)
    shared = n > 1
    row, column = row[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    met = np.zeros((len(left), len(right)), dtype=bool)
    for c in range(0, int(shared.sum()), COLUMNS):
        here = (column >= c) & (column < c + COLUMNS)
        member = np.zeros((len(at) - 1, COLUMNS), dtype=np.float32)
        member[row[here], column[here] - c] = 1
        met |= member[left] @ member[right].T > 0
    return met


def _runs(batches, names):
    """Tables of whole runs of rows with equal ``names`` (rows come sorted)."""
    import numpy as np
    import pyarrow as pa

    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        keys = [t[n].to_numpy() for n in names]
        edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if len(edge):
            yield t.slice(0, edge[-1]), np.append(0, edge)
            held = t.slice(edge[-1])
        else:
            held = t
    if held is not None and len(held):
        yield held, np.array([0, len(held)])


def _compare(cosine: float):
    """Sorted blocks of buckets -> [node, links, other]: links that count here,
    and with ``other`` those that join what was apart in the block."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for t, edges in _runs(batches, ("dims", "bucket", "x", "y")):
            t = t.combine_chunks()
            node, own, weight, bucket, x, y = (t[n].to_numpy() for n in ("node", "own", "copies", "bucket", "x", "y"))
            by_length = [(rows, unit) for rows, unit in _units(t["embedding"].chunk(0))]
            lists = t["buckets"].chunk(0)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            length = np.zeros(len(t), dtype=np.int64)
            for k, (rows, _) in enumerate(by_length):
                length[rows] = k
            nodes, links, others = [], [], []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if e - s < 2:
                    continue
                rows, unit = by_length[length[s]]  # vectors of a block have one length
                first = np.searchsorted(rows, s)
                unit = unit[first:first + e - s]
                left = np.flatnonzero(own[s:e] == x[s])
                right = left if x[s] == y[s] else np.flatnonzero(own[s:e] == y[s])
                near = unit[left] @ unit[right].T >= cosine
                if x[s] == y[s]:
                    near = np.triu(near, 1)
                if not near.any():
                    continue
                near &= ~_met_before(at[s:e + 1], values, bucket[s], left, right)
                i, j = np.nonzero(near)
                i, j = left[i], right[j]
                n = (np.bincount(i, weights=weight[s + j], minlength=e - s) + np.bincount(j, weights=weight[s + i], minlength=e - s))
                linked = np.flatnonzero(n)
                nodes += node[s + linked].tolist()
                links += n[linked].astype(int).tolist()
                others += [None] * len(linked)
                parent = list(range(e - s))

                def top(c):
                    while parent[c] != c:
                        parent[c] = c = parent[parent[c]]
                    return c
                for p, q in zip(i.tolist(), j.tolist()):
                    p, q = top(p), top(q)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        nodes.append(int(node[s + p]))
                        links.append(0)
                        others.append(int(node[s + q]))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links, pa.int64()), pa.array(others, pa.int64())],
                                             names=["node", "links", "other"])
    return run


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """One row for each row of ``vectors``: [vec_id, n_links, component_id, kept].

    Two vectors link when buckets bring them together and their cosine, in
    double precision, is at least ``cosine``.  ``n_links`` counts the other
    rows that a row links with; equal vectors are one class, whose copies are
    counted and not listed.  ``component_id`` is the least id that links reach,
    and the vector of that id is kept.  Vectors that are null, empty or zero or
    hold null or non-finite components link with nothing and are kept, as are
    rows with a null id (which have no component and are no links of others);
    vectors of different lengths never link.  Rows that share an id and a
    vector are copies; rows that share only the id share links and component.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    known = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    classes = known.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    schema = StructType(list(classes.schema.fields)).add("buckets", ArrayType(LongType()))
    hashed = written(classes.mapInArrow(_hashed, schema).withColumn("id", F.monotonically_increasing_id()), "vectors")

    places = hashed.select("id", F.size("embedding").alias("dims"), F.explode(F.array_distinct("buckets")).alias("bucket"))
    members = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("two")]
    size = (places.groupBy("dims", "bucket").agg(*members).filter("n > 1")
            .groupBy("dims", "n", "one", "two").agg(F.min("bucket").alias("bucket"))
            .select("dims", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    mine = written(places.join(size, ["dims", "bucket"]), "vector-buckets")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (mine.select("dims", "bucket", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("dims", "bucket", "id", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    vectors_of = (mine.groupBy("id").agg(F.collect_list("bucket").alias("buckets"))
                  .join(hashed.select("id", "node", "copies", "embedding"), "id"))
    block = ["dims", "bucket", "x", "y"]
    blocks = dealt.join(vectors_of, "id").repartition(partitions(vectors.sparkSession), *block).sortWithinPartitions(*block)
    found = written(blocks.mapInArrow(_compare(cosine), "node long, links long, other long"), "vector-links")
    star = components(found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))

    shared = (hashed.select("embedding", "node", "copies").join(links, "node", "left").join(star, "node", "left")
              .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "node").alias("component")).filter("n_links > 0"))
    out = rows.join(shared, "embedding", "left")
    component = F.when(F.col("vec_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
