"""Joins that keep their balance when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.session import cut

#: a table of at most so many bytes is sent to every task
BROADCAST_BYTES = 64 << 20
#: rows of one key that a shuffled join gives to one task
HOT_ROWS = 100_000
#: groups of keys, by hash, whose rows are counted to find hot keys
HASH_GROUPS = 1 << 20


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], rows: str, spread: Sequence[str], size: Column | None = None,
                small: int = BROADCAST_BYTES, hot: int = HOT_ROWS) -> DataFrame:
    """Left outer join with ``right``, whose keys ``on`` are unique and whose column ``rows`` tells how many rows of ``left``
    have the key.  ``size`` estimates the bytes of a row of ``right`` (64 if not given); ``right`` should be cheap to read twice.

    Up to ``small`` bytes ``right`` goes to every task.  Beyond, a key of more than ``hot`` rows is dealt over several tasks by
    the hash of ``spread``; only these keys' hashes, at most one for each ``hot`` rows of ``left``, are sent to all tasks.
    """
    on = list(on)
    weight = F.lit(64) if size is None else size
    if (right.agg(F.sum(weight)).first()[0] or 0) <= small:
        return left.join(F.broadcast(right.drop(rows)), on, "left")
    parts = F.ceil(F.col(rows) / hot).cast("int")
    heavy = F.broadcast(right.where(F.col(rows) > hot).groupBy(F.xxhash64(*on).alias("__hot")).agg(F.max(parts).alias("__parts")))
    dealt = left.withColumn("__hot", F.xxhash64(*on)).join(heavy, "__hot", "left")
    dealt = dealt.withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("__parts")).cast("int"), F.lit(0)))
    copies = right.drop(rows).withColumn("__hot", F.xxhash64(*on)).join(heavy, "__hot", "left")
    copies = copies.withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
    return dealt.drop("__hot", "__parts").join(copies.drop("__hot", "__parts"), [*on, "__part"], "left").drop("__part")


def split_hot(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    """``df`` as (rows whose ``keys`` have at most ``limit`` rows, the others or None): keys are counted by groups of
    hashes, so a key may be among the others because of its group, never the other way.  ``df`` should be cheap to read twice."""
    group = F.pmod(F.xxhash64(*keys), F.lit(HASH_GROUPS)).alias("__group")
    hot = cut(df.groupBy(group).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).select("__group"))
    if hot.isEmpty():
        return df, None
    marked = df.withColumn("__group", F.pmod(F.xxhash64(*keys), F.lit(HASH_GROUPS)))
    return tuple(marked.join(F.broadcast(hot), "__group", how).drop("__group") for how in ("left_anti", "left_semi"))
