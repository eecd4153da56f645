"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_fasta(df: DataFrame, path: str, group: str | None = None, id_col: str = "id", seq: str = "seq") -> None:
    """One record per row; one folder per group where a group column is named."""
    text = F.concat(F.lit(">"), F.col(id_col).cast("string"), F.lit("\n"), F.col(seq)).alias("value")
    if group:
        df.select(text, group).write.mode("overwrite").partitionBy(group).text(path)
    else:
        df.select(text).write.mode("overwrite").text(path)


def publish_table(df: DataFrame, path: str, key: str) -> None:
    """Replaces the partitions of the keys in ``df`` and leaves the others; readers see a
    partition before or after, never half of it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_channel(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Per-candidate channel with fixed columns as a tab-separated table; absent columns
    are written empty."""
    have = set(df.columns)
    df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option(
        "sep", "\t").option("header", True).csv(path)
