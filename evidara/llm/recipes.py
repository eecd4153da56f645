"""Exact duplicates by chunk recipes, in DataFrame functions only.

A text is cut into chunks where its own characters say so.  A chunk's identifier is a digest; all distinct chunks
meet once to verify that no two contents share an identifier.  From then on a document is its recipe, the ordered
list of its chunks' identifiers: documents are equal if their recipes are, and long texts move no more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.joins import join_unique
from evidara.llm.common import ascii_lower, stash

LEAST, MOST = 256, 2048
#: characters other than A-Z that ``lower`` may change; unassigned ones may be letters in a later version of Unicode
_OTHER_CAPITALS = r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]"

#: identifiers of a chunk, the shortest first; the last one is the chunk itself, which two contents never share
DIGESTS: tuple[Callable[[Column], Column], ...] = (lambda c: F.xxhash64(c), lambda c: F.sha2(c, 256), lambda c: c)


def folded(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else.  ``lower`` does that at a tenth of the cost of a character
    table where no other character has a lower case."""
    return F.when(text.rlike(_OTHER_CAPITALS), ascii_lower(text)).otherwise(F.lower(text))


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Chunks of ``text`` in order, none for the empty one.

    After ``least`` characters a chunk ends behind the next letter of a fixed set that white space or
    punctuation and one of a few letters follow, after ``most`` characters anywhere, so an insertion
    changes the chunks around it and no others.  ``most`` is at least ``least`` + 6.
    """
    border = r"[aeinrst][\s\p{P}]{1,4}[a-m\P{ASCII}]"
    pattern = f"(?s).{{{least}}}.{{0,{most - least - 6}}}?{border}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _shared(pieces: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Identifiers that different chunks have in common."""
    known = pieces.select(digest(F.col("chunk")).alias("id"), "chunk").distinct()
    return known.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def verified(pieces: DataFrame, digests: Sequence[Callable[[Column], Column]] = DIGESTS) -> Callable[[Column], Column]:
    """The first of ``digests`` that tells all chunks of ``pieces`` (chunk) apart, compared by content."""
    for digest in digests[:-1]:
        if _shared(pieces, digest).isEmpty():
            return digest
    return digests[-1]


def exact_groups(docs: DataFrame, least: int = LEAST, most: int = MOST, digests: Sequence[Callable[[Column], Column]] = DIGESTS,
                 **join) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs`` (doc_id, text).

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty, and all empty texts are
    equal.  ``keep_id`` is the largest doc_id of the equal texts, ``group_size`` counts their rows, ``kept``
    marks the rows of that doc_id, ``text_sha256`` is the hex digest of the lower-cased text.  Repeated rows
    give one row each, and all that have the largest doc_id are kept.  Rows without doc_id count and are kept
    only where no equal text has one.  Texts of any length; further columns are ignored; an empty table gives
    no rows.  ``join`` goes to :func:`evidara.joins.join_unique`.
    """
    cut = docs.select("doc_id", chunks(folded(F.coalesce("text", F.lit(""))), least, most).alias("chunks"))
    # an inner explode would infer a filter on the array and cut the text a second time for it
    digest = verified(cut.select(F.explode_outer("chunks").alias("chunk")).where("chunk is not null"), digests)
    recipe = F.transform("chunks", digest)
    rows = stash(cut.select("doc_id", recipe.alias("recipe"), F.sha2(F.array_join("chunks", "").cast("binary"), 256).alias("text_sha256")))
    rows = rows.withColumn("code", F.xxhash64("recipe"))
    groups = rows.groupBy("code", "recipe").agg(F.max("doc_id").alias("head"), F.count("*").alias("size")).where("size > 1")
    groups = stash(groups.withColumn("rows", F.col("size")))
    got = join_unique(rows, groups, ["code", "recipe"], "rows", ["doc_id"], 64 + 16 * F.size("recipe"), **join)
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    got = got.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    return got.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) without the rows whose text a row of a larger doc_id repeats."""
    gone = exact_groups(docs).where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    keyed = docs.withColumn("__sha", F.sha2(folded(F.coalesce("text", F.lit(""))).cast("binary"), 256))
    return keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__id"]) & (keyed["__sha"] == gone["__sha"]), "left_anti").select(*docs.columns)
