"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Links (a, b) -> (id, component), for each id that is linked; a component is its smallest id.

    Alternates large-star and small-star steps: every node hangs its larger (its smaller) neighbours
    on its smallest, until each node has one link and hangs on one that has none. Each step is a minimum
    by node, pre-aggregated, and a join of the links with it, which adaptive execution splits for a node of
    very many links. Rounds grow with the logarithm of the size; each result is written to the shared folder.
    Loops and repeated links are ignored.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    edges = stored(links.where("a <> b").select(big.alias("u"), small.alias("v")).distinct())
    for _ in range(max_rounds):
        if _settled(edges):
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        # Large-star: larger neighbours of a node go to the smallest of it and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = stored(moved.distinct())
        # Small-star: smaller neighbours, and the node, go to the smallest.
        least = moved.groupBy("u").agg(F.min("v").alias("m"))
        hung = moved.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError("components did not settle")


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components once more links (a, b) are added to those that gave ``labels``."""
    return components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links.select("a", "b")))


def _settled(edges: DataFrame) -> bool:
    """Whether links (u, v) are stars: each u has one, and no v is a u."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").isEmpty()
