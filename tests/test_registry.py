"""Every registered query against its DuckDB oracle at sf0.001 (whole tables)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from revdrift.plans import queries as Q
from support import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["page", "w", "lambda", "version", "intersection", "union_size", "jaccard"]


def test_every_query_has_an_oracle():
    assert set(Q.queries()) == set(Q.oracle_sql())
    assert set(Q.queries()) <= set(E.queries())


def _same(spark, con, name, sf):
    df = Q.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(Q.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    exp = sorted((tuple(_norm(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
    assert got == exp


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    _same(spark, con, name, SF_SMALL)


@pytest.mark.parametrize("partitions", ["8", "32"])
@pytest.mark.parametrize("name", ["corpus_catalog", "skipped_pages", "page_listing", "runtime_summary"])
def test_ranked_queries_on_larger_tables(spark, name, partitions):
    """More rows than a range sample holds."""
    c = duckdb.connect()
    for t in ("documents", "events"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.1/{t}.parquet'")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        _same(spark, c, name, "/root/testdata/sf0.1")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
