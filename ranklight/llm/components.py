"""Connected components of a link table, by alternating star contractions.

Each round points every node's larger neighbours at its smallest neighbour
(large star), then all its smaller neighbours and itself (small star), until
the links no longer change: a forest of stars whose hubs are the smallest
nodes.  A hub's links are never gathered: the minimum is a grouped aggregate,
joined back by key, and Spark splits a hub's rows where they are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import written


def _state(edges: DataFrame):
    h = F.xxhash64("u", "v")
    return edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first()


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node in ``links``; root: the smallest node that
    can be reached from it.  Loops and repeated links do not matter."""
    u, v = F.col(a), F.col(b)
    edges = written(links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        # Large star: neighbours of both directions, the larger ones move.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = written(large, "large-star")
        # Small star: edges point from the larger node to the smaller.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").where("u != v").distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
