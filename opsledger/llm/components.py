"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """Map every node of ``edges`` (a, b: long) to the smallest node it reaches.

    Returns node, component. Nodes without edges are absent; self-loops and rows with a null
    end are ignored. Minima are partial aggregates and the joins back are plain equi-joins,
    which adaptive execution splits when one hub has very many neighbours. Each round is
    written to the shared folder, so a lost executor costs one round. Ends when the
    edge set (count and hash sum) no longer changes: every node then points to its root.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag)
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        seen = mark
        now = stored(_large_star(_small_star(now)), tag)
