"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node that links reach.

    Each round hangs the larger neighbours of a node below its smallest neighbour (large star), then the smaller ones
    (small star), until the edges stay as they are; the rounds grow with the logarithm of the longest chain. A hub's
    neighbours are never gathered: minima are aggregated before the shuffle and joined back, and a hot join key is
    split by the adaptive skew join. Every round is written to the shared folder. Loops and repeated edges are ignored;
    an empty table gives an empty one.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least).filter("a <> b").distinct()
        now = written(small)
        # equal sums of two hashes and equal counts: the same edges as before
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1000000007), F.sum(F.hash("b", "a").cast("long"))).first())
        if seen == mark or not seen[0]:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", F.col("b").alias("c")).distinct())
