"""Connected components of a link table by alternating large-star and small-star rounds.

Every step is a join or an aggregate over links, so nothing gathers in one place: a node
with very many neighbours is a skewed join key, which adaptive execution splits, and a
minimum, which is summed up before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import stored


def _nearest(links: DataFrame) -> DataFrame:
    """Each node's least neighbour."""
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the least of its neighbourhood."""
    both = links.select("u", "v").union(links.select("v", "u"))
    least = _nearest(both).select("u", F.least("u", "least").alias("least"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    least = _nearest(links)
    moved = links.join(least, "u").where(F.col("v") != F.col("least"))
    return (
        moved.select(F.col("v").alias("u"), F.col("least").alias("v"))
        .union(least.select("u", F.col("least").alias("v")))
        .distinct()
    )


def _are_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one centre, and no centre on another."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    roles = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return roles.where((F.col("leaf") > 1) | ((F.col("leaf") > 0) & (F.col("centre") > 0))).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Links may repeat, run either way, or join a node with itself; links with a null end
    count as none. Nodes without any link are not returned.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    while not _are_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
