"""Long-form (row per shingle) shingling equals the array form."""

import pytest
from pyspark.sql import functions as F

from revdrift.operators.longform import bottom_k, shingle_rows
from revdrift.operators.shingle import shingle, sketch
from revdrift.plans import fixtures as fx

from support import SF_SMALL


@pytest.mark.parametrize("w,chunk", [(2, 7), (25, 40), (25, 1 << 16)])
def test_chunks_match_arrays(spark, w, chunk):
    docs = fx.read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    rows = shingle_rows(docs, w, keys=("doc_id",), chunk_tokens=chunk)
    long = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list("shingle")).alias("s"))
    arr = shingle(docs, [w], keys=("doc_id",)).filter(F.size("shingles") > 0).select("doc_id", F.col("shingles").alias("s"))
    assert long.exceptAll(arr).count() == 0 and arr.exceptAll(long).count() == 0
    if w == 25:
        k8 = bottom_k(docs, [w], 8, keys=("doc_id",), chunk_tokens=chunk).groupBy("doc_id").agg(
            F.sort_array(F.collect_list("shingle")).alias("s"))
        sk = sketch(shingle(docs, [w], keys=("doc_id",)), ["8"]).filter(F.size("sketch") > 0).select(
            "doc_id", F.col("sketch").alias("s"))
        assert k8.exceptAll(sk).count() == 0 and sk.exceptAll(k8).count() == 0
