"""Ranked lexical search over impact vectors, pruned by length.

A document is a sparse vector of integer impacts, one for each search term it holds; an item is a vector of term
weights, and the score is their inner product.  Vectors are ordered by length and read in buckets of neighbours:
Cauchy-Schwarz drops whole buckets and the short end of others, the heaviest coordinates of the item bound what
is left of each vector, and only survivors are scored in full, in integers.  The bounds drop nothing that could
reach the threshold, so the result is that of a complete scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.llm.common import BYTES, signed, span_hashes, stash

BATCH_BYTES = 1 << 20
#: terms of the items that are searched for at a time; more items are searched in several blocks
BLOCK_TERMS = 1 << 20
#: longest vectors scored first, for the thresholds of the rest
FIRST_BUCKET = 4096
#: share of an item's squared length that its heaviest coordinates hold
FOCUS = 0.9
#: room for rounding in the bounds
ROOM = 1 + 1e-9
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _slices(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(rows, texts) of about ``limit`` bytes; longer texts are cut where no term is."""
    rows, texts, size = [], [], 0
    for i, value in enumerate(batch.column(batch.schema.get_field_index("text"))):
        value = value.as_py() or b""
        at = 0
        while at < len(value):
            end = at + limit
            if end < len(value):
                # up to the next byte outside terms
                while end < len(value):
                    gap = np.flatnonzero(~_WORD[np.frombuffer(value, np.uint8, min(limit, len(value) - end), end)])
                    if len(gap):
                        end += int(gap[0])
                        break
                    end += limit
            rows.append(i)
            texts.append(value[at:end])
            size += len(texts[-1])
            at = end
            if size >= limit:
                yield np.array(rows), texts
                rows, texts, size = [], [], 0
    if rows:
        yield np.array(rows), texts


def term_line(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all texts in one line: their hashes (with their length, without case of A-Z) and the text of each."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    word = _WORD[data]
    turn = np.flatnonzero(word[1:] != word[:-1]) + 1
    start, end = turn[::2], turn[1::2]
    row = np.searchsorted(np.cumsum([1, *(len(t) + 1 for t in texts)]), start, "right") - 1
    return span_hashes(BYTES.folded[data], start, end), row


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for rows, texts in _slices(batch, BATCH_BYTES):
            line, row = term_line(texts)
            for r, part in zip(rows, np.split(line, np.searchsorted(row, np.arange(1, len(rows))))):
                found[r].append(part)
        terms, counts = [], []
        for parts in found:
            t, c = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
            terms.append(signed(t))
            counts.append(c)
        yield pa.record_batch({"item_id": batch.column(0), "terms": pa.array(terms, pa.list_(pa.int64())), "counts": pa.array(counts, pa.list_(pa.int64()))})


def _lists(row: np.ndarray, rows: int, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.searchsorted(row, np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _count_terms(vocabulary):
    """Documents with a term: their number of terms and the counts of the vocabulary's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            keys, counts = [], []
            for rows, texts in _slices(batch, BATCH_BYTES):
                line, row = term_line(texts)
                row = rows[row]
                n += np.bincount(row, minlength=batch.num_rows)
                at = np.searchsorted(known, line)
                at[at == len(known)] = 0
                hit = known[at] == line if len(known) else np.zeros(len(line), bool)
                key, count = np.unique(row[hit] * max(1, len(known)) + at[hit], return_counts=True)
                keys.append(key)
                counts.append(count)
            key, place = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.empty(0, np.int64),) * 2
            tf = np.zeros(len(key), np.int64)
            if keys:
                np.add.at(tf, place, np.concatenate(counts))
            row, term = np.divmod(key, max(1, len(known)))
            some = np.flatnonzero(n)
            lists = [_lists(row, batch.num_rows, v, pa.int32()).take(pa.array(some)) for v in (term, tf)]
            yield pa.record_batch({"doc_id": batch.column(0).take(pa.array(some)), "n": pa.array(n[some]), "term": lists[0], "tf": lists[1]})
    return run


def _values(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all list items."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), flat


def _impacts(documents: int, total: int):
    """Impact vectors with their lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
                n = n.astype(object)
            m = (75 + 25 * n * documents // total).astype(np.int64)
            row, tf = _values(batch.column(3))
            tf = tf.astype(np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[row])
            square = np.bincount(row, impact.astype(float) ** 2, minlength=batch.num_rows)
            yield pa.record_batch({"length": pa.array(np.sqrt(square)), "doc_id": batch.column(0), "term": batch.column(2),
                                   "impact": _lists(row, batch.num_rows, impact, pa.int32())})
    return run


class Best:
    """The ``k`` best documents of an item so far: higher score first, then the smaller id (none last)."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.least = k, least
        self.score, self.id, self.none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        score, ids, none = np.r_[self.score, score], np.r_[self.id, ids], np.r_[self.none, none]
        order = np.lexsort((ids, none, -score))[: self.k]
        self.score, self.id, self.none = score[order], ids[order], none[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.score[-1]))


class Item:
    """An item's weights, the heaviest first, with the length of what follows each."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(-weights, kind="stable")
        order = order[weights[order] > 0]
        self.terms, self.weights = terms[order], weights[order]
        square = self.weights.astype(float) ** 2
        rest = np.r_[np.cumsum(square[::-1])[::-1], 0.0]
        self.length = math.sqrt(rest[0])
        self.focus = int(np.searchsorted(-rest, -(1 - FOCUS) * rest[0]))
        self.tail = math.sqrt(rest[self.focus])


def search_bucket(items: list[Item], best: list[Best], length: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray,
                  ids: np.ndarray, none: np.ndarray, vocabulary: int) -> tuple[int, int]:
    """Add a bucket's documents to ``best``; rows in descending ``length``.  Returns how many
    (item, document) pairs the lengths left and how many were scored in full."""
    order = np.argsort(term, kind="stable")
    row, impact = row[order], impact[order].astype(np.int64)
    begin = np.searchsorted(term[order], np.arange(vocabulary + 1))
    peak = np.zeros(vocabulary, np.int64)
    filled = np.flatnonzero(np.diff(begin))
    if len(filled):
        peak[filled] = np.maximum.reduceat(impact, begin[filled])
    square = length**2
    looked = scored = 0
    for item, top in zip(items, best):
        if not len(item.terms) or not len(length) or int((item.weights * peak[item.terms]).sum()) < top.least:
            continue
        # Cauchy-Schwarz: beyond this row all vectors are too short
        rows = int(np.searchsorted(-length, -top.least / (item.length * ROOM), "right"))
        if not rows:
            continue
        looked += rows
        total, left = np.zeros(len(length), np.int64), square.copy()
        for t, w in zip(item.terms[: item.focus], item.weights[: item.focus]):
            at = slice(begin[t], begin[t + 1])
            total[row[at]] += w * impact[at]
            left[row[at]] -= impact[at].astype(float) ** 2
        slack = np.sqrt(np.maximum(left[:rows], 0) + 1e-9 * square[:rows])
        alive = np.zeros(len(length), bool)
        alive[:rows] = (total[:rows] + item.tail * slack) * ROOM >= top.least
        scored += int(alive.sum())
        if not alive.any():
            continue
        for t, w in zip(item.terms[item.focus :], item.weights[item.focus :]):
            at = slice(begin[t], begin[t + 1])
            kept = alive[row[at]]
            total[row[at][kept]] += w * impact[at][kept]
        found = np.flatnonzero(alive & (total >= top.least))
        if len(found):
            top.add(total[found], ids[found], none[found])
    return looked, scored


def _search(block, k: int):
    """The ``k`` best documents of each item among the rows of a task, read in descending length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, vocabulary, least = block.value
        items = [Item(*v) for v in vectors]
        best = [Best(k, x) for x in least]
        for batch in batches:
            length = batch.column(0).to_numpy()
            ids = batch.column(1)
            row, term = _values(batch.column(2))
            search_bucket(items, best, length, row, term, _values(batch.column(3))[1], ids.fill_null(0).to_numpy(),
                          ids.is_null().to_numpy(zero_copy_only=False), vocabulary)
        for i, b in enumerate(best):
            if len(b.score):
                yield pa.record_batch({"item": pa.array(np.full(len(b.score), i, np.int32)), "score": pa.array(b.score),
                                       "doc_id": pa.array(b.id, mask=b.none)})
    return run


_FOUND = "item int, score long, doc_id long"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list, k: int, first: int) -> DataFrame:
    """(item, rank, doc_id, score) for a block of items (terms, counts) against all rows of ``docs``."""
    spark = docs.sparkSession
    known = np.unique(np.concatenate([np.array(t, np.int64).view(np.uint64) for t, _ in items]))
    vocabulary = spark.sparkContext.broadcast(known)
    counted = stash(docs.mapInArrow(_count_terms(vocabulary), "doc_id long, n long, term array<int>, tf array<int>"))
    size = counted.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    if not size["n"]:
        return spark.createDataFrame([], _FOUND + ", rank int")
    holders = np.zeros(len(known), np.int64)
    for r in counted.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        holders[r["t"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * size["n"] + 2) / (2 * df + 1))) for df in holders.tolist()], np.int64)
    vectors = []
    for terms, counts in items:
        at = np.searchsorted(known, np.array(terms, np.int64).view(np.uint64))
        vectors.append((at, weight[at] * np.array(counts, np.int64)))
    lengthy = counted.where("size(term) > 0").mapInArrow(
        _impacts(size["n"], size["l"]), "length double, doc_id long, term array<int>, impact array<int>")
    # thresholds from the longest vectors; their number decides how much is pruned, not what is found
    border = lengthy.select("length").orderBy(F.desc("length")).limit(first).agg(F.min("length")).first()[0]
    least = [1] * len(items)
    if border is not None:
        start = spark.sparkContext.broadcast((vectors, len(known), least))
        head = lengthy.where(F.col("length") >= border).sortWithinPartitions(F.desc("length"))
        for r in _top(head.mapInArrow(_search(start, k), _FOUND), k).where(F.col("rank") == k).collect():
            least[r["item"]] = r["score"]
    block = spark.sparkContext.broadcast((vectors, len(known), least))
    ordered = lengthy.repartitionByRange(F.desc("length"), "doc_id").sortWithinPartitions(F.desc("length"))
    return _top(ordered.mapInArrow(_search(block, k), _FOUND), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, first: int = FIRST_BUCKET, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, text).

    Terms are runs of digits, letters a-z without case, and all characters beyond ASCII, of whole texts.  With N documents
    that hold a term, L terms in all, n in a document, df documents with a term and tf occurrences, a term weighs
    floor(1000 ln((2N+2)/(2df+1))) and gives a document (10^9 tf) div (1000 tf + 12 m), m = 75 + (25 n N) div L; scores sum
    weight times impact over the item's terms, repeats included.  Only scores above 0 are ranked; equal ones by
    ascending doc_id, rows without id last.

    Null and empty texts hold no terms: such documents are never found, such items have no rows.  Repeated rows of
    either table count as documents and items of their own.  Terms are compared by 64-bit hashes of their bytes
    and length.  Further columns are ignored; empty tables give no rows.  Items are searched in blocks of
    ``block_terms`` terms, each against all documents.
    """
    spark = docs.sparkSession
    texts = [t.select(i, F.col("text").cast("binary").alias("text")) for t, i in ((docs, "doc_id"), (items, "item_id"))]
    asked = texts[1].mapInArrow(_item_terms, "item_id long, terms array<long>, counts array<long>").where("size(terms) > 0")
    asked = stash(asked.withColumn("number", F.monotonically_increasing_id()))
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        mine = asked.where(F.pmod("number", F.lit(blocks)) == b).orderBy("number").collect()
        if not mine:
            continue
        found = _search_block(texts[0], [(r["terms"], r["counts"]) for r in mine], k, first)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], "item int, item_id long")
        out = out.union(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
