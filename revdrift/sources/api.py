"""Landed API responses (JSON text) -> revision rows and rendered HTML.

The HTTP client itself is not part of this library; responses are landed as
text (one JSON document per row) and parsed here with ``from_json`` against
an explicit schema, so the work is spread over the cluster like any scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVISION = T.StructType([
    T.StructField("revid", T.LongType()),
    T.StructField("parentid", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("user", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("comment", T.StringType()),
])

REVISIONS_RESPONSE = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.ArrayType(T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("revisions", T.ArrayType(REVISION)),
        ]))),
    ])),
    T.StructField("continue", T.StructType([T.StructField("rvcontinue", T.StringType())])),
])


def revisions_from_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """[title, revid, parentid, timestamp, user, size, comment, rvcontinue]:
    one row per revision of ``query.pages[0].revisions``."""
    parsed = responses.select(F.from_json(F.col(body), REVISIONS_RESPONSE).alias("_r"))
    first = parsed.select(
        F.get(F.col("_r.query.pages"), 0).alias("_p"), F.col("_r.continue.rvcontinue").alias("rvcontinue"))
    return first.select(
        F.col("_p.title").alias("title"), "rvcontinue",
        F.inline(F.coalesce(F.col("_p.revisions"), F.array().cast(T.ArrayType(REVISION)))))


def html_from_parse_response(body: Column | str) -> Column:
    """``parse.text`` of a parse response; NULL when absent (report those rows)."""
    b = F.col(body) if isinstance(body, str) else body
    return F.get_json_object(b, "$.parse.text")


def split_parse_responses(responses: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(ok rows with ``html``, rejected rows without ``parse.text``)."""
    with_html = responses.withColumn("html", html_from_parse_response(body))
    return with_html.filter(F.col("html").isNotNull()), with_html.filter(F.col("html").isNull())
