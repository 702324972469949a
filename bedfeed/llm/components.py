"""Connected components of a large graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """One row (node, component) for every node of the edges (a, b): the smallest node it can reach.

    Each round hangs the larger neighbours of a node, then the smaller ones, under the smallest of them. Groups
    are only reduced to minima and joined, never gathered; a hot node is a skewed join key, which Spark splits.
    The edges of every round are a table in the shared folder, so a lost executor costs no round.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.where("a <> b").select(a, b).distinct())
    before = None
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()) != before:
        before = state
        if not state[0]:
            break
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        now = stored(small.distinct())
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
