"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import stored


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every linked node but those that are their component's smallest.

    Large-star and small-star steps in turn, each an aggregation and a join, so no
    node's neighbours ever meet in one task; each round is stored. Links of a node
    with itself, repeated links and links with null are allowed and add nothing.
    """
    plain = links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(plain.distinct(), "links")
    for _ in range(rounds):
        if _is_forest_of_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = stored(_small_star(_large_star(edges)).distinct(), "links")
    raise RuntimeError(f"components not found in {rounds} rounds")


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one itself."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (
        moved.where("v != m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
    )
