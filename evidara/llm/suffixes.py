"""Repeated byte strings: difference-cover suffix sorting over shards of the corpus.

Every window of ``length`` bytes has an owner, the smallest hash among its ``GRAM``-byte
grams; equal windows have equal owners, so the suffixes that can share ``length`` bytes all lie
in one shard by owner and the shards are sorted side by side.  Runs of neighbouring windows
with one owner that occur twice as a whole are settled by counting; what is left, the edges of
repeated passages, is sorted: ranks of sampled triples, recursion on their names, merge of the
remaining suffixes, then neighbours compare their first ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.llm.common import ODD, doc_batches, merge_spans, mix, signed, split_by_ids, stash, window_runs

GRAM = 32
BATCH_BYTES = 1 << 19
#: bytes whose suffixes one task sorts at a time
SHARD_BYTES = 1 << 20
#: an owner with more distinct runs is split window by window, and two places of each window are sorted
HOT_RUNS = 1_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` (positive integers below 2**20 or ranks of
    fewer symbols than that) in order: difference cover modulo 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    shift = np.int64(int(t.max()) + 1)
    # sort the sampled triples and name them
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triple = _names(_pair(_pair(t[sample], t[sample + 1], shift), t[sample + 2], shift))
    distinct = int(triple.max())
    if distinct < len(sample):
        order = suffix_array(triple)
    else:
        order = np.empty(len(sample), np.int64)
        order[triple - 1] = np.arange(len(sample))
    ranked = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[ranked] = np.arange(1, len(ranked) + 1)
    # the remaining suffixes follow from one symbol and a known rank
    zero = np.arange(0, n, 3)
    wide = np.int64(len(ranked) + 1)
    key0 = _pair(t[zero], rank[zero + 1], wide)
    zero = zero[np.argsort(key0)]
    # merge: how many sampled suffixes of each class stand before a remaining one
    ranked = ranked[ranked < n]
    first, second = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    before = np.searchsorted(_pair(t[first], rank[first + 1], wide), _pair(t[zero], rank[zero + 1], wide))
    triple_key = [_pair(_pair(t[x], t[x + 1], shift), rank[x + 2], wide) for x in (second, zero)]
    before = before + np.searchsorted(*triple_key)
    out = np.empty(n, np.int64)
    at = before + np.arange(len(zero))
    out[at] = zero
    free = np.ones(n, bool)
    free[at] = False
    out[free] = ranked
    return out


def _pair(a: np.ndarray, b: np.ndarray, base: np.int64) -> np.ndarray:
    return a * base + b


def _names(key: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct keys, from 1."""
    order = np.argsort(key)
    new = np.r_[True, np.diff(key[order]) != 0]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new)
    return out


def byte_grams(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each position, by doubling."""
    h, factor, width = data.astype(np.uint64) + np.uint64(1), int(ODD), 1
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        width *= 2
    return mix(h)


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for start, rows in doc_batches(batch, "text", BATCH_BYTES):
                for index, base, text in _slices(rows, length):
                    data = np.frombuffer(text, np.uint8)
                    if len(data) < length:
                        continue
                    grams = byte_grams(data)
                    first, n, owner = window_runs(grams, index, length, GRAM)
                    raw = memoryview(text)
                    content = np.fromiter((xxhash.xxh3_64_intdigest(raw[a : a + m + length - 1]) for a, m in zip(first.tolist(), n.tolist())),
                                          np.uint64, len(first))
                    yield pa.record_batch({
                        "owner": pa.array(signed(grams[owner])), "run": pa.array(signed(content)),
                        "key": pa.array(keys[start + index[first]]), "at": pa.array(base[first]), "n": pa.array(n.astype(np.int32))})
    return run


RUN_SCHEMA = "owner long, run long, key long, at long, n int"


def _slices(rows: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Row number of each byte, place of each byte in its row, the bytes: neighbouring short
    rows together, a long row in slices that overlap by a window less one byte."""
    group, size = [], 0
    for i, t in enumerate(rows):
        if len(t) > 2 * BATCH_BYTES:
            for a in range(0, len(t) - length + 1, BATCH_BYTES):
                piece = t[a : a + BATCH_BYTES + length - 1]
                yield np.full(len(piece), i), np.arange(a, a + len(piece)), piece
        elif len(t) >= length:
            group.append((i, t))
            size += len(t)
    if group:
        sizes = [len(t) for _, t in group]
        begin = np.cumsum([0, *sizes[:-1]])
        yield (np.repeat([i for i, _ in group], sizes), np.arange(size) - np.repeat(begin, sizes), b"".join(t for _, t in group))


def _windows(length: int):
    """Windows of the wanted runs: (key, text, wanted) to WINDOW_SCHEMA, ``window`` the hash of a window's bytes."""
    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.record_batch([pa.array(c) for c in columns], names=["window", "key", "at", "undecided"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for key, row, wanted in zip(*batch.columns):
                key, raw = key.as_py(), memoryview(row.as_py() or b"")
                for w in wanted.as_py():
                    at = np.arange(w["at"], w["at"] + w["n"])
                    window = np.fromiter((xxhash.xxh3_64_intdigest(raw[a : a + length]) for a in at.tolist()), np.uint64, len(at))
                    out.append((signed(window), np.full(len(at), key, np.int64), at, np.full(len(at), w["undecided"])))
                    size += len(at)
                    if size >= 100_000:
                        yield flush(out)
                        out, size = [], 0
        if out:
            yield flush(out)
    return run


WINDOW_SCHEMA = "window long, key long, at long, undecided boolean"


def _passages(length: int):
    """Bytes of the wanted runs: (text, wanted, hot) to (owner, run, undecided, hot, data)."""
    names = ["owner", "run", "undecided", "hot", "data"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]

    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [()] * len(names)
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for row, wanted, hot in zip(*batch.columns):
                text, hot = row.as_py() or b"", hot.as_py()
                for w in wanted.as_py():
                    out.append((w["owner"], w["run"], w["undecided"], hot, text[w["at"] : w["at"] + w["n"] + length - 1]))
                    if len(out) >= 10_000:
                        yield flush(out)
                        out = []
        yield flush(out)
    return run


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Per piece, which of its windows also start elsewhere in the pieces."""
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(np.r_[0, sizes[:-1] + 1])
    text = np.frombuffer(b"\0".join(pieces), np.uint8).astype(np.int64) + 1
    order = suffix_array(text)
    inside = np.zeros(len(text), bool)
    for b, s in zip(begin.tolist(), sizes.tolist()):
        inside[b : b + s - length + 1] = True
    order = order[inside[order]]
    view = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint8), length)
    same = np.zeros(len(order) + 1, bool)
    for a in range(0, len(order) - 1, 20_000):
        left, right = order[a : a + 20_000], order[a + 1 : a + 20_001]
        m = len(right)
        same[a + 1 : a + 1 + m] = (view[left[:m]] == view[right]).all(1)
    hit = np.zeros(len(text), bool)
    hit[order] = same[:-1] | same[1:]
    return [hit[b : b + s - length + 1] for b, s in zip(begin.tolist(), sizes.tolist())]


def _sort(length: int):
    def run(_, part):
        out = []
        hits = repeated_starts(part["data"].tolist(), length)
        for owner, run_, undecided, hot, hit in zip(part["owner"], part["run"], part["undecided"], part["hot"], hits):
            if undecided:
                edges = np.flatnonzero(np.diff(np.r_[0, hit, 0]))
                out += [(owner, run_, hot, a, b - a) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
        return pd.DataFrame(out, columns=["owner", "run", "hot", "skip", "m"]).astype(
            {"owner": "int64", "run": "int64", "hot": "bool", "skip": "int64", "m": "int32"})
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__key", F.xxhash64("doc_id", "text"))


def repeated_spans(keyed: DataFrame, length: int) -> DataFrame:
    """(key, spans): runs of windows that start anywhere else too, as (first byte, windows)."""
    rows = keyed.select(F.col("__key").alias("key"), F.col("text").cast("binary").alias("text"))
    runs = stash(rows.mapInArrow(_runs(length), RUN_SCHEMA))
    owners = runs.groupBy("owner").agg(F.count("*").alias("all")).where("all > 1").select("owner")
    distinct = runs.groupBy("owner", "run").agg(F.count("*").alias("copies"), F.min(F.struct("key", "at")).alias("rep"), F.any_value("n").alias("n"))
    distinct = stash(distinct.join(owners, "owner").select("owner", "run", "n", "copies", "rep.*"))
    load = distinct.groupBy("owner").agg(F.min("copies").alias("least"), F.count("*").alias("runs")).where("least = 1")
    wanted = distinct.join(load.select("owner", (F.col("runs") > HOT_RUNS).alias("hot")), "owner")
    wanted = stash(wanted.groupBy("key", "hot").agg(F.collect_list(F.struct("owner", "run", "at", "n", (F.col("copies") == 1).alias("undecided"))).alias("wanted")))
    sizes = {r["hot"]: r["size"] for r in wanted.groupBy("hot").agg(F.sum(F.aggregate(
        "wanted", F.lit(0).cast("long"), lambda s, w: s + w["n"] + length)).alias("size")).collect()}
    total = sizes.get(False, 0)
    # a run that occurs twice as a whole is repeated wherever it stands
    spans = runs.join(distinct.where("copies > 1").select("owner", "run"), ["owner", "run"]).select("key", "at", "n")
    if sizes:
        texts, _ = split_by_ids(rows, wanted.select("key"), ["key"])
        texts = texts.dropDuplicates(["key"])
        pieces = wanted.where("not hot").select("key", "wanted", "hot")
        if True in sizes:
            # of each window of a hot owner that occurs twice, two places are sorted, however many there are
            windows = stash(texts.join(wanted.where("hot"), "key").select("key", "text", "wanted").mapInArrow(_windows(length), WINDOW_SCHEMA))
            place = F.struct("key", "at")
            twice = stash(windows.groupBy("window").agg(F.count("*").alias("all"), F.max("undecided").alias("open"), F.array(F.min(place), F.max(place)).alias("two"))
                          .where("all > 1 and open").select("window", "two"))
            total += 2 * length * twice.count()
            two = twice.select("window", F.explode("two").alias("p")).select("window", "p.*")
            pieces = pieces.union(two.groupBy("key").agg(F.collect_list(F.struct(
                F.col("window").alias("owner"), F.lit(0).cast("long").alias("run"), "at", F.lit(1).alias("n"), F.lit(True).alias("undecided")))
                .alias("wanted")).withColumn("hot", F.lit(True)))
        parts = texts.join(pieces, "key").select("text", "wanted", "hot").mapInArrow(
            _passages(length), "owner long, run long, undecided boolean, hot boolean, data binary")
        shards = max(1, -(-int(total) // SHARD_BYTES))
        found = parts.groupBy(F.pmod("owner", F.lit(shards)).alias("shard")).applyInPandas(
            _sort(length), "owner long, run long, hot boolean, skip long, m int")
        if True in sizes:
            found = stash(found)
            repeated, _ = split_by_ids(windows.where("undecided"), found.where("hot").select(F.col("owner").alias("window")).distinct(), ["window"])
            spans = spans.union(repeated.select("key", "at", F.lit(1)))
            found = found.where("not hot")
        edges = distinct.where("copies = 1").join(found, ["owner", "run"])
        spans = spans.union(edges.select("key", F.col("at") + F.col("skip"), "m"))
    return spans.groupBy("key").agg(F.collect_list(F.struct("at", "n")).alias("spans"))


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for row, spans in zip(batch.column(1), batch.column(2)):
                text, spans = row.as_py() or b"", spans.as_py() or []
                at = np.array([s["at"] for s in spans], np.int64)
                at, end = merge_spans(at, at + np.array([s["n"] for s in spans], np.int64) + length - 1)
                kept, place = hashlib.sha256(), 0
                for a, b in zip(at.tolist(), end.tolist()):
                    kept.update(text[place:a])
                    place = b
                kept.update(text[place:])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(int((end - at).sum()))
                out["n_spans"].append(len(at))
                out["kept_sha256"].append(kept.hexdigest())
            yield pa.record_batch([batch.column(0)] + [pa.array(v, pa.string() if c == "kept_sha256" else pa.int64()) for c, v in out.items()],
                                  names=["doc_id", *out])
    return run


def removal_digests(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs`` (doc_id, text).

    A byte of a text (UTF-8) goes if a string of ``length`` bytes that covers it also starts
    anywhere else in the table, in the same text included; strings never cross texts and are
    judged on the input.  ``n_spans`` counts the maximal runs of bytes that went.  Null and empty
    texts have no bytes (the hash is that of no bytes).  Rows are judged one by one whatever their
    doc_id, also null or repeated; a repeated row repeats every string.  Further columns are
    ignored; an empty table gives no rows.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    found = stash(repeated_spans(keyed, length))
    touched, clean = split_by_ids(keyed, found.select(F.col("key").alias("__key")), ["__key"])
    touched = touched.join(found.withColumnRenamed("key", "__key"), "__key")
    clean = clean.withColumn("spans", F.lit(None).cast("array<struct<at:bigint,n:int>>"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    parts = [p.select("doc_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(_cut(length), schema) for p in (touched, clean)]
    return parts[0].union(parts[1])
