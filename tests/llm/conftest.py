import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    """The smallest tables' folder."""
    return SF


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in "documents embeddings labels".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and wordless texts, repeated rows and ids, a long text, clashing columns."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (2, text), (2, text), (3, text.upper()), (4, None), (5, ""), (6, " \t\n "), (7, "a b"), (8, "A  B"),
            (9, "b a"), (None, text), (None, None), (10, "x " * 30_000), (11, "x " * 30_000 + "y"), (7, "other text under the same id"),
            (12, "café \U0001f600 日本語    <|endoftext|>"), (13, " lead"), (14, "trail "), (15, "\x1f\x85 \xa0")]
    return spark.createDataFrame(
        [(i, t, "en", 0, False, 9, b"k", "n") for i, t in rows],
        "doc_id long, text string, lang string, component_id int, kept boolean, score int, key binary, node string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
