"""Connected components by star contraction over DataFrames.

Every round is two aggregations and two joins on the edge list; the edge list
is written to the shared folder between rounds and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.filter("b <= a")
    low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = near.join(low, "a")
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Columns node, root (smallest node of the component) for every node of an edge.

    edges: long columns a, b; loops and repeated edges don't matter.  Raises if
    ``max_rounds`` don't suffice (rounds grow with the logarithm of the size).
    """
    edges = cut(edges.filter("a is not null and b is not null and a <> b").distinct(), "edges")
    sign = F.struct(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
    seen = None
    for _ in range(max_rounds):
        edges = cut(_star(_star(edges, True), False), "edges")
        now = edges.select(sign.alias("s")).first()[0]
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components: no fixed point")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select(F.col("root"), "root")).distinct()
