"""Exact deduplication with an extendible-hash index on shared files.

Keys are 64-bit hashes of the text's bytes, ordered as unsigned numbers.  A
directory maps the leading ``depth`` bits of a key to a bucket: a bucket with
more distinct keys than ``bucket_entries``, or more bytes of text than
``bucket_bytes``, is split by its next bit, and the directory doubles when the
bucket was as deep as the directory itself.  Buckets are dealt to owner tasks in
key order, by bytes, so an owner has one range of keys.  It gets all entries of
its range, compares the bytes of entries with equal keys, numbers different
texts of one key as a chain, and writes its buckets, sorted, to the index.

An index is a folder on shared files: ``directory`` (one row a slot), ``entries``
(one row a different text, with the text) and ``settings``, written last.  It is
never changed: ``insert`` writes a new one beside it, with fuller buckets split.

Texts travel once for each map task that has them: a map task first collapses
the equal texts of its batches.  Texts that make up a ten-thousandth of all rows
or more (so 10,000 at most, at any size) are merged by salted groups before, as
every map task has them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, partitions, scratch_folder, stored, then_forget, written

#: Bytes of text that a map task holds while it collapses equal texts.
COMBINE_BYTES = 32 << 20
#: Bytes of text of an owner's buckets, for which an owner is added.
OWNER_BYTES = 64 << 20
#: One key of so many rows or more of all rows is merged by salted groups first.
HOT_ONE_IN = 10_000
SALTS = 256


@dataclass(frozen=True)
class Index:
    """A written index: [bucket, key, chain, n_bytes, text, text_sha256, keep_id,
    group_size] and [slot, bucket, owner] for each of ``2 ** depth`` slots."""

    path: str
    depth: int
    key_bits: int
    bucket_entries: int
    bucket_bytes: int
    max_depth: int
    entries: DataFrame
    directory: DataFrame

    def bucket_of(self, rows: DataFrame, key: str = "key", bucket: str = "bucket") -> DataFrame:
        """``rows`` with the bucket that the directory (``2 ** max_depth`` rows at
        most, sent to all tasks) names for their key."""
        slots = self.directory.select(F.col("slot").alias("__slot"), F.col("bucket").alias(bucket))
        return rows.withColumn("__slot", _slot(key, self.depth)).join(F.broadcast(slots), "__slot").drop("__slot")


def _split(counts: dict[int, int], sizes: dict[int, int], bucket_entries: int, bucket_bytes: float,
           max_depth: int) -> tuple[int, list[tuple[int, int, int]]]:
    """(depth, [(bits of its own, their value, bytes)] of each bucket in key order)."""
    from itertools import accumulate

    slots = 1 << max_depth
    keys = [0, *accumulate(counts.get(p, 0) for p in range(slots))]
    size = [0, *accumulate(sizes.get(p, 0) for p in range(slots))]
    depth, buckets, todo = 0, [], [(0, 0)]
    while todo:
        bits, value = todo.pop()
        low, high = value << (max_depth - bits), (value + 1) << (max_depth - bits)
        n, held = keys[high] - keys[low], size[high] - size[low]
        if bits < max_depth and n > 1 and (n > bucket_entries or held > bucket_bytes):
            depth = max(depth, bits + 1)  # the directory doubles
            todo += [(bits + 1, 2 * value + 1), (bits + 1, 2 * value)]
        else:
            buckets.append((bits, value, held))
    return depth, buckets


def directory(counts: dict[int, int], bucket_entries: int, max_depth: int) -> tuple[int, list[int]]:
    """(depth, bucket of each slot) from the number of keys of each
    ``max_depth``-bit prefix.  Buckets are numbered in key order."""
    depth, buckets = _split(counts, {}, bucket_entries, float("inf"), max_depth)
    return depth, [b for b, (bits, _, _) in enumerate(buckets) for _ in range(1 << (depth - bits))]


def owners(sizes: Iterable[int], least: int) -> list[int]:
    """The owner of each bucket: ranges of buckets of about equal bytes, ``least``
    of them or one for each ``OWNER_BYTES``.  A bucket is not parted."""
    sizes = [s + 1 for s in sizes]  # buckets without text count a little
    total = sum(sizes)
    n, before, found = max(least, -(-total // OWNER_BYTES)), 0, []
    for s in sizes:
        found.append(before * n // total)
        before += s
    return found


def _collapse(batches):
    """[doc_id, key, text] -> one row for each different text of some batches."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def collapse(held):
        t = pa.Table.from_batches(held)
        t = t.set_column(2, "text", pc.cast(t["text"], pa.large_string()))
        t = t.group_by(["key", "text"]).aggregate([("doc_id", "max"), ("doc_id", "count", pc.CountOptions(mode="all"))])
        return pa.RecordBatch.from_arrays(
            [t["key"].combine_chunks(), pc.cast(t["text"], pa.string()).combine_chunks(),
             t["doc_id_max"].combine_chunks(), t["doc_id_count"].combine_chunks()],
            names=["key", "text", "keep_id", "group_size"])

    forget()
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= COMBINE_BYTES:
            yield collapse(held)
            held, size = [], 0
    if held:
        yield collapse(held)


def _key(text: Column, key_bits: int) -> Column:
    key = F.xxhash64(text)
    if key_bits < 64:  # for tests: few bits make collisions
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    return key


def _slot(key: str, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text, key_bits).alias("key"), text.alias("text"))


def _merged(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def _distinct_texts(keyed: DataFrame, census: DataFrame) -> DataFrame:
    """[key, text, keep_id, group_size]: rows that map tasks have collapsed."""
    total = census.agg(F.sum("rows")).first()[0] or 0
    hot = F.broadcast(census.filter((F.col("rows") > 1) & (F.col("rows") * HOT_ONE_IN >= total)).select("key"))
    rare = keyed.join(hot, "key", "left_anti").select("doc_id", "key", "text").mapInArrow(
        then_forget(_collapse), "key long, text string, keep_id long, group_size long")
    common = keyed.join(hot, "key", "left_semi").select(
        "key", "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    return rare.unionByName(_merged(_merged(common, "key", "text", "salt"), "key", "text"))


def _build(docs: DataFrame, id_col: str, text_col: str, old: Index | None, *, bucket_entries: int = 8192,
           bucket_bytes: int = 8 << 20, max_depth: int = 16, key_bits: int = 64) -> Index:
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col, key_bits)
    census = written(keyed.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.octet_length("text")).cast("long").alias("n_bytes")),
                     "exact-census")
    texts, keys = _distinct_texts(keyed, census), census.select("key", "n_bytes")
    if old is not None:
        texts = texts.unionByName(old.entries.select("key", "text", "keep_id", "group_size"))
        keys = keys.unionByName(old.entries.select("key", "n_bytes")).groupBy("key").agg(F.max("n_bytes").alias("n_bytes"))
    prefixes = keys.groupBy(_slot("key", max_depth).alias("prefix")).agg(F.count("*"), F.sum("n_bytes")).collect()
    depth, buckets = _split({r[0]: r[1] for r in prefixes}, {r[0]: r[2] for r in prefixes}, bucket_entries, bucket_bytes, max_depth)
    owner = owners((size for _, _, size in buckets), partitions(spark))

    path = scratch_folder(spark, "exact-index")
    slots = (b for b, (bits, _, _) in enumerate(buckets) for _ in range(1 << (depth - bits)))
    places = stored(spark.createDataFrame([(s, b, owner[b]) for s, b in enumerate(slots)], "slot long, bucket int, owner int").coalesce(1),
                    f"{path}/directory")
    placed = texts.withColumn("slot", _slot("key", depth)).join(F.broadcast(places), "slot")
    different = _merged(placed.repartitionById(max(owner) + 1, F.col("owner")), "owner", "bucket", "key", "text").withColumn(
        "text_sha256", F.sha2(F.col("text"), 256))
    chain = Window.partitionBy("owner", "bucket", "key").orderBy("text_sha256")
    entries = stored(
        different.withColumn("chain", F.row_number().over(chain) - 1).sortWithinPartitions("bucket", "key", "chain").select(
            "bucket", "key", "chain", F.octet_length("text").cast("long").alias("n_bytes"), "text", "text_sha256", "keep_id", "group_size"),
        f"{path}/entries", compression="zstd")
    settings = dict(depth=depth, key_bits=key_bits, bucket_entries=bucket_entries, bucket_bytes=bucket_bytes, max_depth=max_depth)
    stored(spark.createDataFrame([tuple(settings.values())], ", ".join(f"{k} long" for k in settings)).coalesce(1), f"{path}/settings")
    return Index(path, entries=entries, directory=places, **settings)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> Index:
    """The written index of ``docs``: one entry for each different text.

    ``chain`` counts from 0 within a key, ``keep_id`` is the largest id of the
    text's rows and ``group_size`` their number.  Settings: ``bucket_entries``,
    ``bucket_bytes``, ``max_depth``, ``key_bits``.  The directory is made from at
    most ``2 ** max_depth`` pairs of counts; a bucket of that depth, or of one
    key, takes all its entries, however many.  A text of any length is one entry.
    """
    return _build(docs, id_col, text_col, None, **settings)


def open_index(spark: SparkSession, path: str) -> Index:
    """The index that was written to ``path``."""
    settings = spark.read.parquet(f"{path}/settings").first().asDict()
    return Index(path, entries=spark.read.parquet(f"{path}/entries"), directory=spark.read.parquet(f"{path}/directory"), **settings)


def insert(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """A new index of the old one's rows and of ``docs``.

    Its texts are compared byte by byte with those of their keys; buckets that
    become overfull are split, and the directory doubles where it must.  Rows
    that are in the old index already count again.
    """
    return _build(docs, id_col, text_col, index, bucket_entries=index.bucket_entries, bucket_bytes=index.bucket_bytes,
                  max_depth=index.max_depth, key_bits=index.key_bits)


def lookup(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1) -> DataFrame:
    """One row for each row of ``docs``: [doc_id, text_sha256, keep_id, group_size]
    of its entry, found by bucket, key and place in the key's chain (whose texts
    differ, so their digests tell them apart); nulls where there is none of
    ``least`` rows or more."""
    rows = _keyed(docs, id_col, text_col, index.key_bits).select("doc_id", "key", F.sha2(F.col("text"), 256).alias("text_sha256"))
    entries = index.entries.filter(F.col("group_size") >= least).select("bucket", "key", "text_sha256", "keep_id", "group_size")
    return (index.bucket_of(rows).join(entries, ["bucket", "key", "text_sha256"], "left")
            .select("doc_id", "text_sha256", "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """One row for each row of ``docs``: [doc_id, keep_id, group_size, kept, text_sha256].

    Equal texts have the same bytes; a null text counts as empty.  The row with
    the largest id stays.  Rows repeated with the same id and text all count in
    ``group_size`` and share the decision; null ids rank below every number,
    and a text all of whose ids are null keeps a null ``keep_id`` and its rows.
    Texts may have any length.  Other columns of ``docs`` are ignored; an empty
    table gives no rows.
    """
    found = lookup(build_index(docs, id_col, text_col, **settings), docs, id_col, text_col, least=2)  # a row without is its text's only one
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """The rows of ``docs`` that stay, one for each different text, with all columns.

    Of equal texts that is the row with the largest id; of rows that also
    repeat the id, any one.  Columns may have any names but those that begin
    with ``__``.  Nulls, long texts and empty tables are as in ``exact_dedup``.
    """
    index = build_index(docs, id_col, text_col, **settings)
    shared = index.entries.filter("group_size > 1").select(
        F.col("bucket").alias("__bucket"), F.col("key").alias("__key"), F.col("text_sha256").alias("__sha"),
        F.col("keep_id").alias("__keep"), F.lit(True).alias("__shared"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = index.bucket_of(docs.withColumns({"__key": _key(text, index.key_bits), "__sha": F.sha2(text, 256)}), "__key", "__bucket")
    j = keyed.join(shared, ["__bucket", "__key", "__sha"], "left")
    alone = j.filter(F.col("__shared").isNull())
    first = j.filter(F.col("__shared") & F.col(id_col).cast("long").eqNullSafe(F.col("__keep"))).dropDuplicates(["__key", "__sha"])
    return alone.unionByName(first).select(*docs.columns)
