"""Connected components of a graph too large for one machine, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stash


def components(edges: DataFrame) -> DataFrame:
    """``vertex, component`` (the smallest vertex it reaches) of every vertex in ``edges`` (``a, b``, whole numbers).

    Each round hangs vertices below the smallest neighbour; rounds grow with the logarithm of the longest path. Minima are
    aggregated before the shuffle and joined back, so a vertex with very many edges is never gathered in one task. Each
    round is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stash(large, "large-star")
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stash(moved.union(root).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
        if now == state:
            break
        state = now
    roots = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "vertex")
    return roots.union(roots.select("component", "component").distinct())
