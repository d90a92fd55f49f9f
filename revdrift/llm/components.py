"""Connected components of a distributed graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _least(edges: DataFrame) -> DataFrame:
    """[u, m]: the least of each u and its neighbours v."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .filter("u > v").distinct())
    down = large.join(_least(large), "u")
    return (down.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .unionByName(down.select("u", F.col("m").alias("v"))).filter("u > v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """[node, component] for the nodes of ``edges`` [a, b] (long, not null).

    ``component`` is the least node that can be reached.  Each round is
    written to the shared folder; nodes of very many edges only ever meet
    minima (combined before the shuffle) and joins that Spark can split.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    now, seen = written(ordered, "edges"), None
    while True:
        state = now.agg(F.count("*"), *[F.bit_xor(F.xxhash64("u", "v", F.lit(k))) for k in (1, 2)]).first()  # 128 bits of the set of edges
        if state == seen or not state[0]:
            break
        seen, now = state, written(_round(now), "edges")
    # a star forest: every node but the least of its component has one edge, to that
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
