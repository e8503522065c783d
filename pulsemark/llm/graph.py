"""Connected components of a table of links, by alternating star contractions.

Every round hangs nodes below the smallest neighbour they know (first all larger neighbours, then all smaller ones), so a
chain halves and a star is done at once. Rounds are written to the shared folder; nothing but a few numbers per round
reaches the driver. The smallest neighbours are partial aggregates, and the joins on a node can be split, so a node with
very many links is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import stored


def _hang(links: DataFrame) -> DataFrame:
    """For links (u, v) that hold every neighbour v of u: the smallest of u and its neighbours, as ``m``."""
    least = links.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
    return links.join(least, "u")


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs below one node only, which hangs below none."""
    rows, nodes = edges.agg(F.count("*"), F.countDistinct("u")).first()
    if rows != nodes:
        return False
    roots = edges.select(F.col("v").alias("u")).distinct()
    return rows == 0 or edges.join(roots, "u", "left_semi").limit(1).count() == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; the root is the smallest node of its component."""
    edges = stored(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _hang(large)
        edges = stored(near.select("u", F.col("m").alias("v")).unionByName(
            near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
