"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.storage import shared_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """df kept in the session's shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _star(sides: DataFrame, keep: Column) -> DataFrame:
    """Links each kept neighbour v of u to the smallest of u and its neighbours."""
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return sides.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node and component (the smallest node that it reaches) of every node on an edge.

    Edges have no direction; loops count as mentioning their node, edges with a null end are left out,
    repeated edges change nothing, and no edges give no rows. Each round is checkpointed. A node with
    many neighbours is an ordinary key of a join, which adaptive execution splits.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).na.drop()
    pairs = checkpointed(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    loops, now = pairs.filter("u = v").select("u"), pairs.filter("u <> v")
    mark = None
    while True:
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(sides, F.col("v") > F.col("u")).filter("u <> v").distinct()
        # In the small step a node keeps to its smaller neighbours, and links itself and them to the smallest.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        now = checkpointed(small)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    members = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    alone = now.select(F.col("v").alias("node")).unionByName(loops.select(F.col("u").alias("node"))).distinct().join(members, "node", "left_anti").select("node", F.col("node").alias("component"))
    return members.unionByName(alone)
