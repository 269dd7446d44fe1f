"""Connected components of an edge table in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (smallest node reachable) for every node that has an edge.

    Alternating stars: each node hangs its larger neighbours, then its smaller
    ones, on the smallest neighbour, until nothing changes. A node's minimum is
    a partial aggregate, so a node with very many edges needs no list of them.
    Nothing but two numbers a round reaches the driver."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, before = checkpointed(e), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").unionByName(e.select("u", F.col("u").alias("v")).distinct()).join(least, "u") \
            .where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = checkpointed(small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
                         .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = e.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
