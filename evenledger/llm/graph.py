"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import drop_saved, saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long); the component is its smallest node.

    Each round joins every node to its smallest neighbour (large star), then to the smallest of its smaller
    neighbours (small star). Rounds grow with the logarithm of the longest path. Minima are formed before the
    shuffle, so a node with very many neighbours costs one row for each task. Loops, repeated edges and edges with
    a null end are ignored. Nothing is collected but whether a round left stars only.
    """
    pairs = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = saved(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        drop_saved(pairs)
        pairs = after
        ends = after.select("u", "v", F.lit(1).alias("tail")).unionByName(after.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v"), F.lit(0).alias("tail")))
        roles = ends.groupBy("u").agg(F.sum("tail").alias("out"), F.sum(1 - F.col("tail")).alias("in"))
        if roles.where("out > 1 or (out > 0 and in > 0)").isEmpty():  # stars only
            break
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
