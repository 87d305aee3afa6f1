"""Connected components of a graph of any size, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's least node.

    Each round hangs all neighbours of a node below the least of them, first the greater
    ones, then the smaller ones, until every component is a star. Rounds grow with the
    logarithm of the longest path. The least neighbours are written before they are joined,
    so that a node with very many neighbours is a join that Spark can split.
    """
    up, down = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = scratch.keep(edges.where("a <> b").select(up, down).distinct(), "edges")
    n = now.count()
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = scratch.keep(least, "least", n)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.keep(large.where("u <> v").distinct(), "large-star", n)
        least = scratch.keep(large.groupBy("u").agg(F.min("v").alias("m")), "least", n)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.withColumnRenamed("m", "v")).distinct()
        now = scratch.keep(small, "small-star", n)
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one other at most, which itself hangs below none."""
    parents = edges.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("other"))
    if not parents.where("v <> other").isEmpty():
        return False
    return edges.select("v").join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
