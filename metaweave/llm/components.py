"""Connected components of a link table, by alternating stars in a bounded number of shuffles a round.

Every round is written to the shared folder, so the lineage stays short and a lost
executor costs one round at most. Neighbour minima are combined on the map side; a
node with very many links is on the side of the join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked to, directly or not) for every linked node but roots."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    edges = saved(links.select(hi.alias("u"), lo.alias("v")).where("u > v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        edges = saved(_small_star(_large_star(edges).distinct()).distinct(), "links")
