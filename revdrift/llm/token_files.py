"""Token-id files: Parquet list columns, in ascending document order.

Each file holds [doc_id, file, place, n_tokens, ids].  Ids are dictionary
encoded (a vocabulary's worth of values, bit-packed), the counters
delta-packed; row groups and pages have set sizes and page indexes, so a read
of the counters touches no ids, and a range of documents only its pages.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import encode_texts, library_coder
from .common import partitions

SCHEMA = "doc_id long, file int, place long, n_tokens long, ids array<int>"

#: Parquet writer settings of the token files.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#place": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def _encoder(path: str, end_id: int | None, special_as_text: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        file, place = TaskContext.get().partitionId(), 0
        for b in batches:
            for row, ids, offsets in encode_texts(b.column(1), library_coder(path, special_as_text)):
                n = np.diff(offsets)
                if end_id is not None:
                    ids = np.insert(ids, offsets[1:], end_id)
                    offsets = offsets + np.arange(len(offsets))
                    n = n + 1
                ends = place + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, len(n)), pa.array(np.full(len(n), file, np.int32)),
                     pa.array(ends - n), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    names=["doc_id", "file", "place", "n_tokens", "ids"])
                place = int(ends[-1])
    return run


def write_tokens(docs: DataFrame, tokenizer: str, *, out: str | None = None, end_id: int | None = 0,
                 id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> str:
    """Encode whole texts and write them in ascending id order; returns the folder.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers
    library; no special tokens are added.  Their strings in a text are their
    ids, as the library has it; ``special_as_text`` makes them ordinary text.  ``end_id`` is put behind each document
    (None: nothing).  A null text counts as empty.  Null ids come first; rows
    that share an id follow each other in the order of a hash of their text.
    Other columns are ignored; an empty table gives a folder without rows.
    """
    spark = docs.sparkSession
    out = out or scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ("doc_id", F.xxhash64("text"))
    (rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
         .mapInArrow(_encoder(tokenizer, end_id, special_as_text), SCHEMA)
         .write.options(**LAYOUT).parquet(out))
    return out


def read_tokens(spark: SparkSession, folder: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """[doc_id, start, n_tokens, ids] of the documents with first <= id <= last.

    ``start`` is the number of ids before the document in all files.  Column
    selection and the id range reach the Parquet scan.  Only the sums of the
    files are broadcast, 12 bytes for each file of the folder.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)
    sizes = files.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row for each file
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    if first is not None:
        files = files.filter(F.col("doc_id") >= first)
    if last is not None:
        files = files.filter(F.col("doc_id") <= last)
    return files.join(F.broadcast(before), "file").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids")


def with_crc32(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_crc32`` in place of its ids: the unsigned crc32 of
    them as little-endian unsigned 32-bit integers."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != ids_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            lists = b.column(b.schema.get_field_index(ids_col))
            at = lists.offsets.to_numpy()
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False).view(np.uint8))
            crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(at[:-1], at[1:])]
            yield b.drop_columns([ids_col]).append_column("ids_crc32", pa.array(crc, pa.int64()))
    return df.mapInArrow(run, schema + ", ids_crc32 long")
