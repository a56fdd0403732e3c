"""Connected components of an edge list, by alternating large-star and small-star steps.

Each step connects nodes to smaller neighbours of their neighbourhood: every pass is one aggregation and
one join on stored tables, and the number of passes grows with the logarithm of the size. No node's
neighbours are collected: a star needs its smallest member only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (longs ``a``, ``b``): the smallest node reachable.

    Loops and repeated edges are allowed; null ends are dropped. The result is read from ``scratch``.
    """
    ends = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null")
    nodes = scratch.save(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    # pairs (u, v) with u > v
    pairs = ends.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = scratch.save(pairs)
    before = None
    while True:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: each larger neighbour of u goes to the smallest of u's neighbourhood
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        pairs = scratch.save(small.where("u <> v").distinct())
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == (state["n"], state["h"]):
            break
        before = (state["n"], state["h"])
    found = nodes.join(pairs, nodes["node"] == pairs["u"], "left")
    return found.select("node", F.coalesce("v", "node").alias("component"))
