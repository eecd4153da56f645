"""Repeated word passages: suffix automata over reference shards, matching statistics of the documents.

Every window of ``length`` words has an owner, the smallest hash among its ``GRAM``-word
grams.  Equal windows have equal owners, so the corpus falls into shards by owner and a window
meets only windows of its own shard.  Neighbouring windows with one owner form a run.  Runs
that are equal as a whole are settled by counting; the distinct runs that are left are the
references of a shard.  Their suffix automaton is built in the task that holds the shard, each
state with the smallest document in which its strings end, and the undecided runs stream past
it.  Sending the automata of all shards to all documents would cost shards times documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.llm import common
from evidara.llm.common import BROADCAST_IDS, doc_batches, gram_hashes, merge_spans, signed, span_hashes, split_by_ids, window_runs, word_line

#: the joins between tables are many; their shuffle files go with each table written
stash = partial(common.stash, release=True)

GRAM = 4
BATCH_BYTES = 1 << 18
#: words in the automaton of one task
SHARD_WORDS = 60_000
#: an owner with more distinct runs is split window by window, and two places of each window meet
HOT_RUNS = 2_000


class SuffixAutomaton:
    """Generalised suffix automaton; every state knows the smallest mark of the strings that end in it."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.mark = [-1], [0], [None]

    def add(self, string: list, mark) -> None:
        """Insert one string."""
        nxt, link, length, marks = self.next, self.link, self.length, self.mark
        last = 0
        for c in string:
            q = nxt[last].get(c)
            if q is not None:
                if length[q] == length[last] + 1:
                    last = q
                else:
                    last = self._clone(last, c, q)
            else:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                marks.append(None)
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
                last = cur
            if marks[last] is None or mark < marks[last]:
                marks[last] = mark

    def _clone(self, p: int, c, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(nxt[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        self.mark.append(None)
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def close(self) -> None:
        """Pass the marks on to all suffixes; call once, after the last string."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up, mark = self.link[v], self.mark[v]
            if up > 0 and (self.mark[up] is None or mark < self.mark[up]):
                self.mark[up] = mark

    def statistics(self, string: list, least: int) -> list[tuple[int, object]]:
        """Per position: length of the longest match that ends here, cut at ``least``, and the
        smallest mark of the strings with that match."""
        nxt, link, length = self.next, self.link, self.length
        v, n, out = 0, 0, []
        for c in string:
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
                while length[link[v]] >= least:
                    v = link[v]
                n = min(n, least)
            out.append((n, self.mark[v]))
        return out


def _owned_runs(rows: list[bytes], length: int):
    """Row, first window, windows and owner hash of every run; the rows' first words; all word hashes in line."""
    hashes, row, begin = word_line(rows)
    grams = gram_hashes(hashes, GRAM)
    first, n, owner = window_runs(grams, row, length, GRAM)
    return row[first], first, n, grams[owner], begin, hashes


def row_key():
    """One number for a row's id and text: equal rows have equal numbers."""
    return F.xxhash64("doc_id", "text").alias("key")


def _owners(length: int):
    """(owner, doc_id) for every run, each owner once in a slice of rows and document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, rows in doc_batches(batch, "text", BATCH_BYTES):
                d, _, _, owner, _, _ = _owned_runs(rows, length)
                yield pa.record_batch({"owner": pa.array(signed(owner)), "doc_id": pa.array(ids[start : start + len(rows)][d], pa.int64())})
    return run


def _runs(length: int):
    """RUN_SCHEMA for every run: its owner, content, row, first window and windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for start, rows in doc_batches(batch, "text", BATCH_BYTES):
                mine, key = ids[start : start + len(rows)], keys[start : start + len(rows)]
                d, first, n, owner, begin, hashes = _owned_runs(rows, length)
                yield pa.record_batch({
                    "owner": pa.array(signed(owner)), "run": pa.array(signed(span_hashes(hashes, first, first + n + length - 1))),
                    "doc_id": pa.array(mine[d], pa.int64()), "key": pa.array(key[d]),
                    "at": pa.array((first - begin[d]).astype(np.int32)), "n": pa.array(n.astype(np.int32)),
                })
    return run


RUN_SCHEMA = "owner long, run long, doc_id long, key long, at int, n int"


def _windows(length: int):
    """Windows of the wanted runs: (doc_id, key, text, wanted) to WINDOW_SCHEMA, ``window`` the hash of a window's words."""
    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.record_batch([pa.array(c) for c in columns], names=["window", "owner", "run", "off", "doc_id", "key", "at", "undecided"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for doc, key, row, wanted in zip(*batch.columns):
                doc, key = doc.as_py(), key.as_py()
                h = word_line([row.as_py() or b""])[0]
                for w in wanted.as_py():
                    off = np.arange(w["n"], dtype=np.int32)
                    first = w["at"] + off
                    owner, run_, mine, mark = (np.full(w["n"], v, np.int64) for v in (w["owner"], w["run"], doc, key))
                    out.append((signed(span_hashes(h[first[0] : first[-1] + length], off, off + length)), owner, run_, off, mine, mark, first.astype(np.int32),
                                np.full(w["n"], w["undecided"])))
                    size += w["n"]
                    if size >= 100_000:
                        yield flush(out)
                        out, size = [], 0
        if out:
            yield flush(out)
    return run


WINDOW_SCHEMA = "window long, owner long, run long, off int, doc_id long, key long, at int, undecided boolean"


def _passages(length: int):
    """Words of the wanted runs of each document: (text, wanted, hot) to (owner, run, least, undecided, hot, words)."""
    names = ["owner", "run", "least", "undecided", "hot", "words"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]

    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [()] * len(names)
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for row, wanted, hot in zip(*batch.columns):
                h, hot = word_line([row.as_py() or b""])[0], hot.as_py()
                for w in wanted.as_py():
                    out.append((w["owner"], w["run"], w["least"], w["undecided"], hot, h[w["at"] : w["at"] + w["n"] + length - 1].tobytes()))
                if len(out) >= 20_000:
                    yield flush(out)
                    out = []
        yield flush(out)
    return run


def _match(length: int):
    def run(_, part):
        # the shard's words as small numbers
        sizes = [len(w) // 8 for w in part["words"]]
        line = np.unique(np.frombuffer(b"".join(part["words"]), np.uint64), return_inverse=True)[1].tolist()
        ends = np.cumsum(sizes).tolist()
        strings = [line[b - n : b] for n, b in zip(sizes, ends)]
        automaton = SuffixAutomaton()
        for string, least in zip(strings, part["least"].tolist()):
            automaton.add(string, least)
        automaton.close()
        out = []
        facts = zip(strings, *(part[c].tolist() for c in ("undecided", "owner", "run", "hot", "least")))
        for string, undecided, owner, run_, hot, least in facts:
            if not undecided:
                continue
            place = None
            for i, (n, mark) in enumerate(automaton.statistics(string, length)[length - 1 :] + [(0, None)]):
                if n >= length and mark < least:
                    place = i if place is None else place
                elif place is not None:
                    out.append((owner, run_, hot, place, i - place))
                    place = None
        return pd.DataFrame(out, columns=["owner", "run", "hot", "skip", "m"]).astype(
            {"owner": "int64", "run": "int64", "hot": "bool", "skip": "int32", "m": "int32"})
    return run


def repeated_windows(docs: DataFrame, length: int = 13) -> DataFrame:
    """(doc_id, key, spans): the runs of windows that also start in a document with a smaller
    doc_id, as an array of (first window, windows), for each document that has any.  ``key`` is
    the number of the row's id and text."""
    rows = docs.where("doc_id is not null").select("doc_id", row_key(), F.col("text").cast("binary").alias("text"))
    runs = rows.mapInArrow(_runs(length), RUN_SCHEMA)
    # owners that occur in several documents, with the first of them
    owners = rows.select("doc_id", "text").mapInArrow(_owners(length), "owner long, doc_id long").groupBy("owner").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    members = stash(runs.join(owners.select("owner", "first"), "owner"))
    distinct = stash(members.groupBy("owner", "run").agg(
        F.min(F.struct("doc_id", "key", "at")).alias("rep"), F.any_value("n").alias("n"), F.any_value("first").alias("first")))
    distinct = distinct.select("owner", "run", "n", "rep.*", (F.col("rep.doc_id") > F.col("first")).alias("undecided"))
    # the first document of a run is undecided where an earlier one holds other runs of the owner
    load = distinct.groupBy("owner").agg(F.max("undecided").alias("open"), F.count("*").alias("runs")).where("open")
    wanted = distinct.join(load.select("owner", (F.col("runs") > HOT_RUNS).alias("hot")), "owner")
    wanted = stash(wanted.groupBy("doc_id", "key", "hot").agg(F.collect_list(F.struct(
        "owner", "run", "at", "n", F.col("doc_id").alias("least"), "undecided")).alias("wanted")))
    sizes = {r["hot"]: r["size"] for r in wanted.groupBy("hot").agg(F.sum(F.aggregate(
        "wanted", F.lit(0).cast("long"), lambda s, w: s + w["n"] + length - 1)).alias("size")).collect()}
    total = sizes.get(False, 0)
    spans = members.join(distinct.select("owner", "run", F.col("doc_id").alias("least")), ["owner", "run"])
    later = spans.where("doc_id > least").select("doc_id", "key", "at", "n")
    if sizes:
        texts, _ = split_by_ids(rows, wanted.select("doc_id").distinct(), ["doc_id"])
        texts = texts.dropDuplicates(["doc_id", "key"])
        pieces = wanted.where("not hot").select("doc_id", "key", "wanted", "hot")
        if True in sizes:
            # of each window of a hot owner that several documents hold, the first place makes the automaton and the last streams past it
            windows = stash(texts.join(wanted.where("hot"), ["doc_id", "key"]).select("doc_id", "key", "text", "wanted").mapInArrow(_windows(length), WINDOW_SCHEMA))
            place = F.struct("doc_id", "key", "at")
            twice = stash(windows.groupBy("window").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a.doc_id < b.doc_id"))
            total += 2 * length * twice.count()
            two = twice.select("window", F.inline(F.array(
                F.struct("a.*", F.lit(False).alias("undecided")), F.struct("b.*", F.lit(True).alias("undecided")))))
            pieces = pieces.union(two.groupBy("doc_id", "key").agg(F.collect_list(F.struct(
                F.col("window").alias("owner"), F.lit(0).cast("long").alias("run"), "at", F.lit(1).alias("n"), F.col("doc_id").alias("least"), "undecided"))
                .alias("wanted")).withColumn("hot", F.lit(True)))
        parts = texts.join(pieces, ["doc_id", "key"]).select("text", "wanted", "hot").mapInArrow(
            _passages(length), "owner long, run long, least long, undecided boolean, hot boolean, words binary")
        shards = max(1, -(-int(total) // SHARD_WORDS))
        found = stash(parts.groupBy(F.pmod("owner", F.lit(shards)).alias("shard")).applyInPandas(
            _match(length), "owner long, run long, hot boolean, skip int, m int"))
        if True in sizes:
            told = found.where("hot").select(F.col("owner").alias("window")).join(twice.select("window", F.col("a.doc_id").alias("least")), "window")
            told = F.broadcast(told) if told.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else told
            repeated = windows.where("undecided").join(told, "window").where("doc_id > least")
            found = found.where("not hot").union(repeated.select("owner", "run", F.lit(True), F.col("off"), F.lit(1)))
        heads = spans.where("doc_id = least").join(found, ["owner", "run"])
        later = later.union(heads.select("doc_id", "key", (F.col("at") + F.col("skip")).alias("at"), F.col("m").alias("n")))
    return later.groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "n")).alias("spans"))


def _cut(length: int, digest: bool):
    """Rows (position of the spans last) without the words that their spans cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("__spans"))
            texts = batch.column(batch.schema.get_field_index("text"))
            kept, total, gone = [], [], []
            for text, span in zip(texts, spans):
                words = (text.as_py() or b"").split()
                span = span.as_py() or []
                at = np.array([s["at"] for s in span], np.int64)
                end = at + np.array([s["n"] for s in span], np.int64) + length - 1
                at, end = merge_spans(at, end)
                left, place = [], 0
                for a, b in zip(at.tolist(), end.tolist()):
                    left += words[place:a]
                    place = b
                left += words[place:]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(hashlib.sha256(b" ".join(left)).hexdigest() if digest else b" ".join(left))
            names = [n for n in batch.schema.names if n not in ("text", "__spans")]
            yield pa.record_batch([batch.column(batch.schema.get_field_index(n)) for n in names] + [
                pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())],
                names=[*names, "__words", "__removed", "__kept"])
    return run


def _parts(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Rows with spans (columns of ``docs`` and ``__spans``) and rows without."""
    found = stash(repeated_windows(docs, length))
    touched, clean = split_by_ids(docs, found.select("doc_id").distinct(), ["doc_id"])
    keyed = touched.withColumn("__key", row_key())
    found = found.select(F.col("doc_id").alias("__doc"), F.col("key").alias("__k"), F.col("spans").alias("__spans"))
    same = (F.col("doc_id") == F.col("__doc")) & (F.col("__key") == F.col("__k"))
    return keyed.join(found, same, "left").drop("__key", "__doc", "__k"), clean


def removal_digests(docs: DataFrame, length: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs`` (doc_id, text).

    Words are runs of other characters than ASCII white space.  A word goes if some window of
    ``length`` words that covers it also starts in a document with a smaller doc_id; windows are
    judged on the input.  Null and empty texts have no words (the hash is that of no bytes).  Rows
    without doc_id lose nothing and are no reference.  Repeated rows of one doc_id are judged one
    by one and are no reference for each other.  Further columns are ignored; an empty table gives
    no rows.
    """
    docs = docs.select("doc_id", "text")
    touched, clean = _parts(docs, length)
    none = F.lit(None).cast("array<struct<at:int,n:int>>")
    schema = "doc_id long, __words long, __removed long, __kept string"

    def done(part: DataFrame) -> DataFrame:
        part = part.select("doc_id", F.col("text").cast("binary").alias("text"), "__spans")
        return part.mapInArrow(_cut(length, True), schema).toDF("doc_id", "n_words", "n_removed", "kept_sha256")

    return done(touched).union(done(clean.withColumn("__spans", none)))


def remove_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``: texts that lose words are the
    kept words joined by single blanks, all others stay as they are.  ``n_chars``, where there is
    such a column, is counted anew for changed texts."""
    touched, clean = _parts(docs, length)
    added = [("__old", T.StringType()), ("__words", T.LongType()), ("__removed", T.LongType()), ("__kept", T.BinaryType())]
    schema = T.StructType([f for f in docs.schema if f.name != "text"] + [T.StructField(n, t) for n, t in added])
    part = touched.withColumn("__old", F.col("text")).withColumn("text", F.col("text").cast("binary"))
    cut = part.mapInArrow(_cut(length, False), schema)
    changed = F.col("__removed") > 0
    cut = cut.withColumn("text", F.when(changed, F.col("__kept").cast("string")).otherwise(F.col("__old")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns).union(clean.select(*docs.columns))
