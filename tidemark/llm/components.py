"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, comp): comp is the smallest node reachable; only nodes with edges appear.

    Each round hangs a node's larger neighbours under its smallest one, then
    the smaller ones; the number of rounds grows with the logarithm of the
    longest path.  Neighbour lists are aggregated, never collected.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots)
