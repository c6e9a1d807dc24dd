"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.shared import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    return edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of the nodes in edges (a, b: long, not null); loops and repeats are fine.

    Each round shuffles edges by node with map-side minima, so a hub is no burden; the edge table is written to the shared
    folder each round, and the rounds end when it no longer changes (about the logarithm of the longest path).
    """
    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = mark(now)
    while before[0]:
        then = materialize(_small_star(_large_star(now)), "edges")
        after = mark(then)
        discard(now)
        now = then
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
