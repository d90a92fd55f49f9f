"""From raw documents to packed token sequences, stage by stage.

Each stage takes what the one before kept, as re-read from Parquet, and returns
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revdrift.llm.common import read, written
from revdrift.llm.exact_dedup import keep_one
from revdrift.llm.near_dedup import near_dedup
from revdrift.llm.packing import pack
from revdrift.llm.quality import QUALITY
from revdrift.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored as toxic go."""
    model = toxicity(docs)
    weights = model.fit(docs, read(spark, sf_dir, "labels"))
    return model.choose(docs, weights, 0)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored as poor go."""
    return QUALITY.choose(docs, QUALITY.fit(docs, read(spark, sf_dir, "labels")), 1)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links reach from one another the least id stays."""
    gone = near_dedup(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """[doc_id, piece, start, length, sequence_id, offset, ids_crc32] of 1024-token sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2).placed.drop("part", "row")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: The classifiers and the packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and re-read."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
