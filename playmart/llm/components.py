"""Connected components by alternating large-star and small-star steps.

The smallest neighbour of a node is taken by an aggregate that Spark combines before the shuffle, and joined
back, so the neighbours of a node are never collected. The smallest neighbours are written to the checkpoint
folder before the join: a join on a plain shuffle is one that Spark can split where a node has very many
edges, one on an aggregate is not. Edges are written after every step too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: connect larger neighbours to the smallest one. Small: the same among smaller neighbours."""
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))  # b < a
    if large:
        ends = ends.union(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = saved(least)
    joined = ends.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node in edges; columns a and b, any order."""
    now = saved(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        now = saved(_star(_star(now, large=True), large=False))
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
