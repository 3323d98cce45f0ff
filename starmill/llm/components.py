"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").filter(F.col("b") != F.col("m"))
    return (
        linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame, label: str) -> DataFrame:
    """``links`` (a, b) of any comparable type to one row per linked node: node, root.

    The root is the smallest node of the component. Each round is written to the shared folder,
    so the plan stays short; the number of rounds grows with the logarithm of the longest chain.
    """
    pairs = links.filter(F.col("a") != F.col("b"))
    edges = store(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-links"
    )

    def state(e: DataFrame) -> tuple:
        hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(e.agg(F.count(F.lit(1)), F.sum(hashed)).first())

    before = state(edges)
    while before[0]:
        edges = store(_small_star(_large_star(edges)), f"{label}-stars")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.union(own)
