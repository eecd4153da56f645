"""Connected components of edge tables of any shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.union(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("m < v").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("m < lo").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.union(least.select(F.col("m").alias("lo"), "hi")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Alternates large-star and small-star steps until the edge set is a forest of stars.
    Rounds grow with the logarithm of the node count, also on chains; there is no cap.
    Self-loops and nulls are left out; no edges give no rows.
    """
    got = edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    state = None
    while True:
        got = cut(got)
        now = got.agg(F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or now == state:
            break
        state = now
        got = _small_star(_large_star(got))
    heads = got.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return got.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(heads)
