"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    other = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return other.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether no node points to two others, or is pointed to and points on."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)").isEmpty()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node each linked node can reach.

    Nodes are non-null longs; nodes without a link have no row. Each round
    writes the contracted links to the shared folder, so lineage stays short and
    a lost executor costs one round. Hubs are aggregated before they are
    shuffled; only whether a node is left to contract reaches the driver.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    while True:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        if _all_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
