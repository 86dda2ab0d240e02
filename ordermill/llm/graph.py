"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of all nodes in ``edges`` (``a, b``, long).

    Alternates two steps until nothing changes: every node hangs its larger
    neighbours on its smallest one, then its smaller ones.  Both keep what is
    connected and need no group of a node's neighbours in memory; the rounds
    grow with the logarithm of the longest chain.
    """
    down = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = down.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = down.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return down.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
