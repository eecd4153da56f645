"""Formats whose lines mean something only below an earlier line (blocks, clusters, reports).

Files are read as lines, so Spark divides them wherever it likes and no row holds a file or a
section.  What a line inherits from earlier lines (the number of its section, the text of the last
mark) is a running value inside its split plus one summary row for each split before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: a split's place among the splits of its file, a line's place among the lines of its split
PLACE = ("split", "line")


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """(value, path, split, line): lines of every file below ``path`` that are not blank.

    ``split`` is the first byte of the part of the file a task reads; ``line`` grows with the lines of
    a split and is comparable inside it only.  A line that crosses the border of two splits
    belongs to the first, as the text source has it.
    """
    rows = spark.read.option("recursiveFileLookup", True).text(path)
    got = rows.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("line"))
    return got.where(F.col("value").rlike(r"\S"))


def with_sections(lines: DataFrame, mark: Column) -> DataFrame:
    """The lines of :func:`read_placed` that are no marks, with ``section`` (from 1, in each file; sections
    without lines are not counted, lines above the first mark are a section) and ``head``, the
    text of the last mark above (null if there is none).

    A window holds one split, of at most ``spark.sql.files.maxPartitionBytes``; the running sum over
    the splits of a file has one row for each.  ``lines`` is read twice.  No lines give no rows.
    """
    inside = Window.partitionBy("path", "split").orderBy("line")
    rows = lines.withColumn("__mark", F.coalesce(mark, F.lit(False)))
    rows = rows.withColumn("__prev", F.lag("__mark").over(inside))
    # a section opens where a line follows a mark; whether the first line of a split does, the splits before it tell
    opens = (~F.col("__mark") & F.coalesce("__prev", F.lit(False))).cast("long")
    each = rows.groupBy("path", "split").agg(
        F.sum(opens).alias("n"), F.min_by("__mark", "line").alias("first"), F.max_by("__mark", "line").alias("last"),
        F.max_by(F.when(F.col("__mark"), F.col("value")), F.when(F.col("__mark"), F.col("line"))).alias("head"))
    by_file = Window.partitionBy("path").orderBy("split")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("starts", (~F.col("first") & F.coalesce(F.lag("last").over(by_file), F.lit(True))).cast("long"))
    carried = each.select(
        "path", "split", (F.coalesce(F.sum(F.col("n") + F.col("starts")).over(earlier), F.lit(0)) + F.col("starts")).alias("__before"),
        F.last("head", True).over(earlier).alias("__head"))
    rows = rows.withColumn("__n", F.sum(opens).over(inside))
    rows = rows.withColumn("__seen", F.last(F.when(F.col("__mark"), F.col("value")), True).over(inside))
    # both sides have one key for each split, so the join goes by the partitioning of the windows
    got = rows.where(~F.col("__mark")).join(carried, ["path", "split"])
    return got.select(*lines.columns, (F.col("__before") + F.col("__n")).alias("section"), F.coalesce("__seen", "__head").alias("head"))


def anchor_blocks(lines: DataFrame) -> DataFrame:
    """Placed lines -> path, block, gene_a, gene_b, evalue; lines that begin with ``#`` part the
    blocks, an unreadable or missing e-value is NaN, lines of one field go."""
    f = F.split("value", "\t")
    rows = with_sections(lines, F.col("value").startswith("#")).where(F.size(f) >= 2)
    return rows.select("path", F.col("section").alias("block"), F.trim(F.get(f, F.lit(0))).alias("gene_a"), F.trim(F.get(f, F.lit(1))).alias("gene_b"),
                       F.coalesce(F.get(f, F.lit(2)).try_cast("double"), F.lit(float("nan"))).alias("evalue"))


def cluster_members(lines: DataFrame) -> DataFrame:
    """Placed lines of ``>Cluster`` sections -> path, cluster (from 0, clusters without lines not counted),
    label (what follows the mark), member, is_rep, identity (null for the representative)."""
    rows = with_sections(lines, F.col("value").startswith(">Cluster")).where(F.col("value").contains(">") & F.col("value").contains("..."))
    return rows.select("path", (F.col("section") - 1).alias("cluster"), F.trim(F.regexp_replace("head", "^>Cluster", "")).alias("label"),
                       F.regexp_extract("value", r">(.+?)\.\.\.", 1).alias("member"), F.trim("value").endswith("*").alias("is_rep"),
                       F.regexp_extract("value", r"([\d.]+)%\s*$", 1).try_cast("double").alias("identity"))


#: fixed values: the columns of a hit in the summary table of a profile report
HIT = r"^\s*(\d+)\s+(\S+).*?\s(\d+(?:\.\d+)?)\s+(\d\S*)\s+(\d\S*)\s+(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s+\d+\s+\d+-\d+\s+\d+-\d+"


def profile_hits(lines: DataFrame, max_evalue: float) -> DataFrame:
    """Placed lines of profile search reports, one or many to a file -> query, no, hit, prob, evalue, score
    of the summary tables up to ``max_evalue``.  A hit belongs to the last ``Query`` line above it
    (query null, if there is none)."""
    rows = with_sections(lines, F.col("value").rlike(r"^Query\s")).where(F.col("value").rlike(HIT))
    part = lambda i: F.regexp_extract("value", HIT, i)
    got = rows.select(F.regexp_extract("head", r"^Query\s+(\S+)", 1).alias("query"), part(1).cast("int").alias("no"), part(2).alias("hit"),
                      part(3).cast("double").alias("prob"), part(4).try_cast("double").alias("evalue"), part(6).cast("double").alias("score"))
    return got.where(F.col("evalue") <= max_evalue)


def aligned_residues(lines: DataFrame) -> DataFrame:
    """Placed lines of structure alignments -> path, tm_score, position, residue: one row for each aligned
    reference position, the last line that names it; gapped and malformed rows go.  ``tm_score`` is
    that of the file's first score line (null if unreadable or absent); a file without aligned
    positions has one row with null position."""
    text = F.trim("value")
    rows = lines.where(~text.startswith("#")).select("path", text.alias("value"), F.struct(*PLACE).alias("place"))
    pair = r"^(\d+)\s+\d+\s+([A-Za-z])$"
    is_pair = F.col("value").rlike(pair)
    files = rows.groupBy("path").agg(F.min_by("value", F.when(F.lower("value").startswith("tm-score"), F.col("place"))).alias("line"))
    score = F.regexp_extract("line", r"\s(\S+)$", 1).try_cast("double")
    found = rows.where(is_pair).groupBy("path", F.regexp_extract("value", pair, 1).cast("int").alias("position")).agg(
        F.max_by(F.upper(F.regexp_extract("value", pair, 2)), "place").alias("residue"))
    return files.select("path", score.alias("tm_score")).join(found, "path", "left")
