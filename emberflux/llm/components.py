"""Connected components of an edge table by alternating star contraction; nothing is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame, tag: str = "stars") -> DataFrame:
    """(node, root) of every node that has an edge in (u, v): root is the smallest node reachable.

    Each round ties every node's larger neighbours, then its smaller ones, to the least neighbour;
    it ends when a round changes nothing, after a number of rounds logarithmic in the nodes.
    """
    edges = C.materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tag)
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if state == seen or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = C.materialize(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).distinct(), tag)
