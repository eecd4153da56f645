"""Row and group filters over sequences, alignments and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.functions.scalars import gap_fraction
from evidara.ordering import picked_values
from evidara.session import cut


def min_tm_filter(predictions: DataFrame, positives: DataFrame, min_tm: int, min_confidence: float) -> DataFrame:
    """Every prediction (seq_id, tm_count, tm_confidence) with its gate flags."""
    hits = positives.select("seq_id").distinct().withColumn("gpcr_positive", F.lit(True))
    got = predictions.join(hits, "seq_id", "left").withColumn("gpcr_positive", F.coalesce("gpcr_positive", F.lit(False)))
    gate = F.col("gpcr_positive") & (F.col("tm_count") >= min_tm) & (F.col("tm_confidence") >= min_confidence)
    return got.withColumn("passed_gate", F.coalesce(gate, F.lit(False)))


def length_bounds(df: DataFrame, length: str, floor: float) -> DataFrame:
    """One row (q1, q3, upper): quartiles are the rows at places n/4 and 3n/4, the upper
    bound is q3 + 1.5 (q3 - q1) but at least ``floor``."""
    q = picked_values(df.select(length), [], length, {"q1": F.floor(F.col("n") / 4), "q3": F.floor(3 * F.col("n") / 4)})
    return q.select("q1", "q3", F.greatest(F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")), F.lit(float(floor))).alias("upper"))


def length_filter_tukey(df: DataFrame, length: str, min_length: int, floor: float = 800) -> DataFrame:
    src = cut(df)
    top = length_bounds(src, length, floor).select("upper").scalar()
    return src.withColumn("__top", top).where((F.col(length) >= min_length) & (F.col(length) <= F.col("__top"))).drop("__top")


def length_filter_max(df: DataFrame, seq: str, most: int) -> DataFrame:
    return df.where(F.length(seq) <= most)


def gap_row_filter(df: DataFrame, seq: str, limit: float = 0.95) -> DataFrame:
    return df.where(gap_fraction(F.col(seq)) < limit)


def prune_alignment(df: DataFrame, seq: str, min_length: int, max_gap_percent: float) -> DataFrame:
    n = F.length(seq)
    share = F.when(n > 0, (n - F.length(F.translate(F.col(seq), "-", ""))) / n * 100).otherwise(0.0)
    return df.where((n >= min_length) & (share <= max_gap_percent))


def alignment_check(df: DataFrame, aln: str, seq: str, min_length: int, max_gap_percent: float) -> DataFrame:
    """(aln, n, min_length, gap_percent, ok) over all rows of each alignment."""
    n = F.length(seq)
    gaps = n - F.length(F.translate(F.col(seq), "-", ""))
    got = df.where(n > 0).groupBy(aln).agg(
        F.count("*").alias("n"), F.min(n).alias("min_length"), (F.sum(gaps) / F.sum(n) * 100).alias("gap_percent")
    )
    return got.withColumn("ok", (F.col("min_length") >= min_length) & (F.col("gap_percent") <= max_gap_percent))


def orthogroup_manifest(members: DataFrame, og: str, focal: Column, reference: Column) -> DataFrame:
    """(og, size, has_focal, has_reference)."""
    return members.groupBy(og).agg(F.count("*").alias("size"), F.max(focal).alias("has_focal"), F.max(reference).alias("has_reference"))


def orthogroup_filter(manifest: DataFrame, min_size: int = 0, focal: bool = False, reference: bool = False) -> DataFrame:
    keep = F.col("size") >= min_size
    keep = keep & F.col("has_focal") if focal else keep
    return manifest.where(keep & F.col("has_reference") if reference else keep)


def min_size_groups(df: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """Rows of the groups with at least ``least`` rows; sizes are counted first, groups
    are never collected."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") >= least)
    return df.join(sizes.drop("__n"), list(keys), "left_semi")
