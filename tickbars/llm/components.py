"""Connected components of a distributed edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.texts import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """(u, v) edges between nodes of any ordered type -> (node, root): root is the least node of the component.

    Rounds of large and small stars, each written to the shared folder; they number about the logarithm of the longest
    path. A hub's edges meet its least neighbour in a join whose other side is a stored table of one row per node, so Spark can
    split them over tasks. Nodes without an edge to another node aren't listed.
    """
    edges = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges")
    state = _state(edges)
    while state[0]:
        # Large star: everything above a node goes to the least node of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        least = stored(least, f"{name}-least")
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = stored(large, f"{name}-large")
        # Small star: what a node points to points to the least of it, and so does the node.
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
        small = large.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-stars")
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
