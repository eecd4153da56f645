"""Benchmark passages in documents: spaced seeds, then alignments that allow substitutions.

A seed is a mask over neighbouring tokens; only the tokens under its ones are hashed, so a
substitution under a zero does not hide the passage.  The hashes of the benchmark go to every
task in shards of bounded size; each document's hashes meet them, and around each hit the item
is laid over the document without gaps and the stretch with the most equal tokens is judged.
Every stretch that counts holds one of the masks, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.llm.common import doc_batches, mix, split_by_ids, stash, word_line

#: masks of weight 5; one of them fits into every stretch of 10 equal tokens or more at IDENTITY
SEEDS = ("11111", "1101011", "110010011", "1010110001", "11001010001", "11100001001", "10100110001")
#: for items that fewer than LEAST_TOKENS equal tokens cover; with SEEDS one fits into every stretch of 5 to 9 at IDENTITY
SHORT_SEEDS = ("101111", "110111", "111011", "111101", "1001111", "1010111", "1011011", "1011101", "1100111", "1101101", "1110011", "1110101",
               "1111001", "11010101", "101000111")
#: a stretch counts from so many equal tokens, or from that share of the item (and SHORT tokens)
LEAST_TOKENS, LEAST_COVER, SHORT = 10, 0.6, 5
#: share of equal tokens in a stretch
IDENTITY = 0.7
#: tokens of benchmark items that one pass over the documents looks for (up to 300 MB of tables, the more the shorter the items)
SHARD_TOKENS = 1_000_000
BATCH_BYTES = 1 << 18
FILTER_BITS = 22
EDGES = b".,;:!?\"'()[]{}*#%&$-_<>|"


def seed_hashes(t: np.ndarray, mask: str) -> np.ndarray:
    n = len(t) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(len(mask)))
    for j, bit in enumerate(mask):
        if bit == "1":
            h = h * np.uint64(0x9E3779B97F4A7C15) + t[j : j + n]
    return mix(h)


def _least(size):
    """Equal tokens from which a stretch covers enough of an item of ``size`` tokens."""
    part, whole = Fraction(str(LEAST_COVER)).as_integer_ratio()
    return np.maximum(SHORT, -(-size * part // whole))


def present(hashes: np.ndarray) -> np.ndarray:
    """Which leading bits occur among ``hashes``, eight to a byte."""
    out = np.zeros(1 << FILTER_BITS, bool)
    out[hashes >> np.uint64(64 - FILTER_BITS)] = True
    return np.packbits(out, bitorder="little")


def occurs(some: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the leading bits of each hash are marked in ``some``."""
    lead = hashes >> np.uint64(64 - FILTER_BITS)
    return (some[lead >> np.uint64(3)] >> (lead & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


class SeedTable:
    """Hashes of a shard of benchmark items for every mask."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        line, row, begin = word_line([t for _, t in items], True, EDGES)
        self.items = np.split(line, begin[1:]) if items else []
        size = np.bincount(row, minlength=len(items))
        shortest = min(len(m) for m in SEEDS)
        # an item too short for every mask is looked for as a whole
        masks = [(m, size >= shortest) for m in SEEDS] + [(m, _least(size) < LEAST_TOKENS) for m in SHORT_SEEDS]
        masks += [("1" * n, size == n) for n in range(1, shortest)]
        self.tables = []
        for mask, wanted in masks:
            h = seed_hashes(line, mask)
            at = np.flatnonzero((row[: len(h)] == row[len(mask) - 1 :]) & wanted[row[: len(h)]])
            if len(at):
                h = h[at]
                order = np.argsort(h, kind="stable")
                place = np.c_[row[at], at - begin[row[at]]].astype(np.int32)[order]
                self.tables.append((mask, h[order], place, present(h)))

    def state(self) -> tuple:
        """Its contents as plain data, to be sent to the tasks; they mark the present hashes anew."""
        return self.ids, self.items, [t[:3] for t in self.tables]

    @classmethod
    def of(cls, state: tuple) -> SeedTable:
        table = cls.__new__(cls)
        table.ids, table.items, tables = state
        table.tables = [(*t, present(t[1])) for t in tables]
        return table

    def hits(self, t: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Distinct (document, item, place of the item's first token) of all seed hits."""
        out = []
        for mask, hashes, place, some in self.tables:
            h = seed_hashes(t, mask)
            at = np.flatnonzero(occurs(some, h))
            at = at[doc[at] == doc[at + len(mask) - 1]]
            lo, hi = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            n = hi - lo
            if n.any():
                which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(at, n)
                out.append(np.c_[doc[at], place[which, 0], at - place[which, 1]])
        return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 3), np.int64)


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Bounds of the stretch with the most equal tokens of those with a share of IDENTITY: from each
    end back to the first place whose sum of (equal - IDENTITY) is not larger."""
    part, whole = Fraction(str(IDENTITY)).as_integer_ratio()
    total = np.r_[0, np.cumsum(np.where(equal, whole - part, -part))]
    count = np.r_[0, np.cumsum(equal)]
    start = np.searchsorted(-np.minimum.accumulate(total), -total)
    end = int(np.argmax(count - count[start]))
    lo = int(start[end])
    return (lo + int(np.argmax(equal[lo:end])), end) if end > lo else (lo, lo)


def judge(item: np.ndarray, text: np.ndarray, first: int) -> tuple[int, int, int] | None:
    """(place in the text, tokens, equal tokens) of the stretch that ``item`` shares with
    ``text`` when its first token lies at ``first``; None if it is too little."""
    a, b = max(0, -first), min(len(item), len(text) - first)
    equal = item[a:b] == text[first + a : first + b]
    lo, hi = best_stretch(equal)
    same = int(equal[lo:hi].sum())
    whole = len(item) <= SHORT and same == len(item)
    return (first + a + lo, hi - lo, same) if whole or same >= min(LEAST_TOKENS, _least(len(item))) else None


def _find(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = SeedTable.of(table.value)
        for batch in batches:
            for start, rows in doc_batches(batch, "text", BATCH_BYTES):
                line, doc, begin = word_line(rows, True, EDGES)
                end = np.r_[begin[1:], len(line)]
                found = []
                for d, i, at in seeds.hits(line, doc).tolist():
                    got = judge(seeds.items[i], line[begin[d] : end[d]], at - int(begin[d]))
                    if got:
                        found.append((start + d, seeds.ids[i], *got))
                if found:
                    row, item, at, size, same = zip(*found)
                    yield pa.record_batch({
                        "doc_id": batch.column(0).take(pa.array(row)), "key": batch.column(1).take(pa.array(row)), "item_id": pa.array(item, pa.int64()),
                        "at": pa.array(at, pa.int64()), "tokens": pa.array(size, pa.int64()), "matched": pa.array(same, pa.int64())})
    return run


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, item_id, at, tokens, matched): stretches of documents that repeat benchmark
    items up to substitutions; ``key`` numbers the row's id and text."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("binary").alias("text"))
    spark = docs.sparkSession
    schema = "doc_id long, key long, item_id long, at long, tokens long, matched long"
    items = benchmark.where("text is not null").select("item_id", F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    shards = int(-(-size // SHARD_TOKENS))
    out = spark.createDataFrame([], schema)
    for s in range(shards):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == s).collect()
        table = spark.sparkContext.broadcast(SeedTable([(r["item_id"], bytes(r["text"])) for r in mine]).state())
        out = out.union(rows.mapInArrow(_find(table), schema))
    return stash(out.distinct())


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, matched), one row per row of ``docs`` (doc_id, text).

    A document is contaminated by an item (``benchmark``: item_id, text) if a gap-free stretch of
    it agrees with the item in at least 10 tokens, or in 60 % of the item and 5 tokens, with at
    least 70 % of the stretch equal; items of up to 5 tokens must agree whole.  Tokens are words
    without case (A-Z) and edge punctuation.  ``item_ids`` are the distinct items in order,
    ``matched`` the most equal tokens of one stretch (0 if there is none).  Null and empty
    texts are not contaminated and contaminate nothing; items without id count, with id null left
    out of ``item_ids``; repeated rows are judged one by one.  Further columns are ignored.
    """
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"))
    found = overlaps(docs, benchmark).groupBy("key").agg(
        F.countDistinct(F.coalesce("item_id", F.lit(-1))).alias("n"), F.sort_array(F.collect_set("item_id")).alias("ids"), F.max("matched").alias("m"))
    got = rows.join(found, "key", "left")
    return got.select("doc_id", F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).alias("n_items"),
                      F.coalesce("ids", F.array().cast("array<long>")).alias("item_ids"), F.coalesce("m", F.lit(0)).alias("matched"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (all its columns) without the rows that repeat a benchmark item."""
    gone = overlaps(docs, benchmark).select(F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    return split_by_ids(keyed, gone, ["__key"])[1].select(*docs.columns)
