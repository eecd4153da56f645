"""Near-duplicate documents: SuperMinHash signatures, bands, verification, components.

SuperMinHash gives each shingle a random permutation of the signature's slots; at step ``j``
the shingle offers the value ``j + r`` to the ``j``-th slot of its permutation.  The values of
later steps are larger than all values of earlier ones, so the steps can stop as soon as every
slot holds a value.  The ranks that one shingle offers are all different, which lowers the
variance of the similarity estimate against independent hash functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.graph import components
from evidara.llm import common
from evidara.llm.common import doc_batches, gram_hashes, mix, signed, split_by_ids, word_line

#: with 4 slots a band and 28 bands a pair at similarity 0.8 shares no band with probability 4e-7
BANDS, BAND_SLOTS = 28, 4
BATCH_BYTES = 1 << 18
ACTIVE_ROWS = 40_000
#: longs of the parity bits that stand for a set in the rest join
BIT_WORDS = 16
#: the joins between tables are many; their shuffle files go with each table written
stash = partial(common.stash, release=True)
_SEED = np.uint64(0x632BE59BD9B4E019)
_MASK = (1 << 64) - 1


def shingle_sets(rows: list[bytes], k: int) -> list[np.ndarray]:
    """Distinct hashes of the ``k``-word shingles of each text, sorted; a shorter text is one shingle."""
    hashes, _, begin = word_line(rows, fold=True)
    grams = gram_hashes(hashes, k)
    out = []
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(hashes)]):
        out.append(np.unique(grams[a : b - k + 1]) if b - a >= k else gram_hashes(hashes[a:b], b - a) if b > a else hashes[:0])
    return out


def _draw(h: np.ndarray, step: int) -> np.ndarray:
    return mix(h + np.uint64(int(_SEED) * (2 * step + 1) & _MASK))


def _offer(slots: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
    """slots[at] = minimum, by sorting the offers."""
    order = np.lexsort((value, at))
    at, value = at[order], value[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    at = at[first]
    slots[at] = np.minimum(slots[at], value[first])


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash of each set (none of them empty): ``len(sets)`` x ``m`` values, step in the
    top byte and the random part below."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    slots = np.full(len(sets) * m, empty, np.uint64)
    items = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # the first step takes one draw: a slot from its top bits, a value from the rest
    r = _draw(items, 0)
    np.minimum.at(slots, doc * m + ((r >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64), _draw(r, 1) >> np.uint64(8))
    open_doc = (slots.reshape(-1, m) == empty).any(1)
    todo = np.flatnonzero(open_doc[doc])
    edge = np.r_[0, np.flatnonzero(np.diff(doc[todo])) + 1, len(todo)] if len(todo) else np.array([0])
    a = 0
    while a < len(edge) - 1:
        # whole documents, so many that their permutations stay small
        b = max(a + 1, int(np.searchsorted(edge, edge[a] + ACTIVE_ROWS, "right")) - 1)
        _later_steps(slots, items, doc, todo[edge[a] : edge[b]], m, empty)
        a = b
    return slots.reshape(-1, m)


def _later_steps(slots: np.ndarray, items: np.ndarray, doc: np.ndarray, rows: np.ndarray, m: int, empty: np.uint64) -> None:
    first = ((_draw(items[rows], 0) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(rows), 1))
    line = np.arange(len(rows))
    perm[line, first], perm[:, 0] = perm[:, 0].copy(), first
    for step in range(1, m):
        r = _draw(items[rows], 2 * step)
        swap = step + ((r >> np.uint64(32)) * np.uint64(m - step) >> np.uint64(32)).astype(np.int64)
        chosen = perm[line, swap]
        perm[line, swap] = perm[line, step]
        perm[line, step] = chosen
        value = (np.uint64(step) << np.uint64(56)) | (_draw(r, 2 * step + 1) >> np.uint64(8))
        _offer(slots, doc[rows] * m + chosen, value)
        still = (slots.reshape(-1, m) == empty).any(1)[doc[rows]]
        if not still.any():
            return
        if not still.all():
            rows, perm = rows[still], perm[still]
            line = np.arange(len(rows))


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets from their signatures."""
    return float((a == b).mean())


def _sign(k: int, bands: int, band_slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in doc_batches(batch, "text", BATCH_BYTES):
                sets = shingle_sets(rows, k)
                full = [i for i, s in enumerate(sets) if len(s)]
                band = np.zeros((len(rows), bands), np.uint64)
                if full:
                    sig = signatures([sets[i] for i in full], bands * band_slots).reshape(len(full), bands, band_slots)
                    h = np.full((len(full), bands), _SEED)
                    for j in range(band_slots):
                        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, j])
                    band[full] = h + np.arange(bands, dtype=np.uint64) * _SEED
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(start, len(rows)),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "same": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    "bands": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, len(rows) * bands + 1, bands), pa.int32()), pa.array(signed(band).ravel())),
                })
    return run


def parity_bits(sets: list[np.ndarray]) -> np.ndarray:
    """Per set ``BIT_WORDS`` longs of bits; an item turns one over.  Two sets differ in at least as
    many items as bits."""
    out = np.zeros(len(sets) * BIT_WORDS, np.uint64)
    items = np.concatenate(sets)
    word = np.repeat(np.arange(len(sets)) * BIT_WORDS, [len(s) for s in sets]) + (items >> np.uint64(58)).astype(np.int64) % BIT_WORDS
    np.bitwise_xor.at(out, word, np.uint64(1) << (items & np.uint64(63)))
    return out.reshape(-1, BIT_WORDS)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows in doc_batches(batch, "text", BATCH_BYTES):
                sets = shingle_sets(rows, k)
                ends = np.r_[0, np.cumsum([len(s) for s in sets])]
                yield pa.record_batch({
                    "same": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    "items": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(np.concatenate(sets)))),
                    "bits": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, len(rows) * BIT_WORDS + 1, BIT_WORDS), pa.int32()), pa.array(signed(parity_bits(sets)).ravel())),
                })
    return run


def _full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(same, items, bits) of the wanted sets (same, id), made anew from the texts of their documents."""
    texts, _ = split_by_ids(docs, wanted.select(F.col("id").alias("doc_id")).distinct(), ["doc_id"])
    made = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(_sets(k), "same binary, items array<long>, bits array<long>")
    return made.join(wanted.select("same").distinct(), "same", "left_semi").dropDuplicates(["same"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between document ids for the pairs whose full sets are similar enough."""
    left = sets.select(F.col("same").alias("sa"), F.col("items").alias("ia"))
    right = sets.select(F.col("same").alias("sb"), F.col("items").alias("ib"))
    met = pairs.join(left, "sa").join(right, "sb")
    both = F.size(F.array_intersect("ia", "ib"))
    return met.where(100 * both >= percent * (F.size("ia") + F.size("ib") - both)).select("a", "b")


def _rest_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Candidates (sa, sb, a, b) among ``sets`` (same, id, c, items, bits) in different components ``c``.

    Only shingles that several components hold can be common to a pair.  A set of ``n`` shingles
    with fewer than ``t n`` of them (``t``: the threshold) has no partner and goes.  Of the ``m``
    shingles left to a set, ``ceil(t n)`` are common to a pair, so two partners share one of the
    first ``m - ceil(t n) + 1`` of either in any common order; the order is by rarity.  The parity
    bits of the sets travel along: where they differ in too many, the sets do.
    """
    base = sets.select(F.xxhash64("same").alias("k"), "same", "id", "c", F.size("items").alias("n"), "items", "bits")
    items = base.select("k", "c", F.explode("items").alias("item"))
    shared = items.groupBy("item").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").cast("int").alias("df")).where("lo < hi")
    order = F.sort_array(F.collect_list(F.struct("df", "item")))
    left = items.select("k", "item").join(shared.select("item", "df"), "item").groupBy("k").agg(order.alias("order"))
    ranked = base.drop("items").join(left, "k").withColumn("m", F.size("order")).where(100 * F.col("m") >= percent * F.col("n"))
    head = F.slice("order", F.lit(1), (F.col("m") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    kept = ["same", "id", "c", "n", "m", "bits"]
    prefix = stash(ranked.select(*kept, F.explode(head).alias("x")).select(*kept, "x.item"))
    left = prefix.toDF("sa", "a", "ca", "na", "ma", "ba", "item")
    right = prefix.toDF("sb", "b", "cb", "nb", "mb", "bb", "item")
    apart = sum((F.bit_count(F.col("ba")[i].bitwiseXOR(F.col("bb")[i])) for i in range(BIT_WORDS)), F.lit(0))
    sizes = F.col("na") + F.col("nb")
    close = (F.col("ca") < F.col("cb")) & ((100 + percent) * F.least("ma", "mb") >= percent * sizes) & ((100 + percent) * (sizes - apart) >= 2 * percent * sizes)
    return left.join(right, "item").where(close).select("sa", "sb", "a", "b").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, band_slots: int = BAND_SLOTS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs`` (doc_id, text).

    Documents whose sets of ``k``-word shingles (words lower-cased in A-Z) have at least
    ``percent`` % of their union in common are linked; a component is what links reach, named
    by its smallest doc_id; ``kept`` marks the document of that id.

    Equal sets collapse to one representative before anything else, so copies cost one row.
    Each bucket of a band compares its members with its smallest member; where that leaves
    several components in one bucket, the missing pairs come from a prefix join over the
    rarest shingles.  Candidates are confirmed on full sets, so no link is wrong, and none is
    left out whose two sets share a bucket.

    Null, empty and blank texts have no shingles and are linked with nothing.  Rows without
    doc_id are linked with nothing and kept, their component null.  Repeated rows of one
    doc_id give one row each; all their texts belong to that one document.  Further columns
    of ``docs`` are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    signed_docs = stash(rows.mapInArrow(_sign(k, bands, band_slots), "doc_id long, n_shingles long, same binary, bands array<long>"))
    linked = signed_docs.where("n_shingles > 0 and doc_id is not null")
    reps = stash(linked.groupBy("same").agg(F.min("doc_id").alias("id"), F.any_value("bands").alias("bands")))
    entries = reps.select("same", "id", F.explode("bands").alias("bucket"))
    ends = entries.groupBy("bucket").agg(F.min(F.struct("id", "same")).alias("lo"), F.count("*").alias("all"))
    pivots = ends.where("all > 1").select("bucket", F.col("lo.same").alias("sa"), F.col("lo.id").alias("a"))
    pairs = entries.join(pivots, "bucket").where("same <> sa")
    pairs = stash(pairs.select("sa", F.col("same").alias("sb"), "a", F.col("id").alias("b")).distinct())
    members = pairs.select(F.explode(F.array(F.struct(F.col("sa").alias("same"), F.col("a").alias("id")),
                                             F.struct(F.col("sb").alias("same"), F.col("b").alias("id")))).alias("x"))
    members = stash(members.select("x.*").distinct())
    # rows of one document with unlike texts tie their sets together
    named = linked.join(reps.select("same", "id"), "same")
    twice = linked.groupBy("doc_id").agg(F.min("same").alias("lo"), F.max("same").alias("hi")).where("lo < hi").select("doc_id")
    own = named.join(twice, "doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    links = stash(_confirmed(pairs, _full_sets(docs, members, k), percent).union(own))
    known = components(links)
    # a bucket whose members still lie in several components
    candidates = entries.join(members.select("same"), "same", "left_semi")
    placed = candidates.join(known, candidates["id"] == known["node"], "left").select(
        "bucket", "same", "id", F.coalesce("component", "id").alias("c"))
    torn = placed.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bucket")
    unsure = stash(placed.join(torn, "bucket").select("same", "id", "c").distinct())
    if not unsure.isEmpty():
        sets = stash(_full_sets(docs, unsure, k).join(unsure, "same"))
        rest = stash(_rest_pairs(sets, percent))
        more = stash(_confirmed(rest, sets, percent))
        if not more.isEmpty():
            known = components(links.union(more))
    tops = reps.select("same", "id").join(known, F.col("id") == F.col("node"), "left").select(
        "same", F.coalesce("component", "id").alias("component_id"))
    placed = signed_docs.join(tops, "same", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (all its columns) without the documents that are not the first of their component.
    Of repeated rows of one doc_id all stay."""
    verdict = near_duplicates(docs, k, percent)
    gone = stash(verdict.where("not kept").select("doc_id").distinct())
    return split_by_ids(docs, gone, ["doc_id"])[1].select(*docs.columns)
