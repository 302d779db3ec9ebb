"""Connected components by repeated star contraction; no group, link or component is ever gathered in one place."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, packed


def connected_components(links: DataFrame, most_rounds: int = 60, pack: bool = False) -> DataFrame:
    """(node, component) for every node that has a link, from links (a, b); the component is its smallest node.

    Large-star and small-star rounds alternate until each node points straight at
    its component's smallest node.  Self links and nulls are dropped.  pack: few links are read in few partitions.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(parent, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(parent.select("u", F.col("m").alias("v")).unionByName(moved).distinct())
        shape = edges.agg(F.count("*").alias("n"), F.count_distinct("u").alias("d")).first()
        edges = packed(edges, shape["n"]) if pack else edges
        children = edges.select(F.col("u").alias("v")).distinct()
        if shape["n"] == shape["d"] and edges.join(children, "v", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
