"""Helpers shared by the pipeline operators: written tables, id filters, word hashes, window owners."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.session import shared_dir

#: ids are sent to every task only up to this many (16 MB of longs); beyond it a shuffled join does the same
BROADCAST_IDS = 2_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame, release: bool = False) -> DataFrame:
    """Write ``df`` once as a compressed table in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` at a fraction of the bytes.  The files go when
    the driver's JVM ends.  With ``release`` the shuffle files of the write go as soon as the
    table is there; otherwise they wait for the driver's garbage collection.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_RELEASE, "false")
    if release:
        spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(_RELEASE, before)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def split_by_ids(df: DataFrame, ids: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key is in ``ids`` and those whose key is not.  A short list goes
    to every task, so that ``df`` stays where it is; a long one is joined by a shuffle."""
    ids = ids.select(*on)
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    side = F.broadcast(ids) if small else ids
    return df.join(side, on, "left_semi"), df.join(side, on, "left_anti")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class _ByteTables:
    """Fixed random numbers for bytes; white space and edge punctuation."""

    def __init__(self) -> None:
        self.number = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.folded = self.number.copy()
        self.folded[ord("A") : ord("Z") + 1] = self.number[ord("a") : ord("z") + 1]
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True


BYTES = _ByteTables()


def word_line(rows: list[bytes], fold: bool = False, edges: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows in one line: their hashes, the row of each, and the first word of each row.

    A word is a run of other bytes than ASCII white space; ``fold`` hashes A-Z as a-z; ``edges``
    are bytes that do not count at the ends of a word that has others."""
    data = np.frombuffer(b" ".join([b"", *rows, b""]), np.uint8)
    space = BYTES.space[data]
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = turn[::2], turn[1::2]
    row = np.searchsorted(np.cumsum([1, *(len(r) + 1 for r in rows)]), start, "right") - 1
    if edges:
        table = np.ones(256, bool)
        table[list(edges)] = False
        core = np.flatnonzero(table[data])
        first, last = np.searchsorted(core, start), np.searchsorted(core, end) - 1
        some = last >= first
        start, end = start.copy(), end.copy()
        kept = table[data[start]] & table[data[end - 1]]
        cut = some & ~kept
        start[cut], end[cut] = core[first[cut]], core[last[cut]] + 1
    hashes = span_hashes((BYTES.folded if fold else BYTES.number)[data], start, end)
    return hashes, row, np.searchsorted(row, np.arange(len(rows)))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbouring word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, k):
        h *= ODD
        h += words[j : j + n]
    return mix(h)


def span_hashes(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the items in each span, the same wherever the span stands: differences of a running
    sum of items times powers of an odd number, divided by the power at the start."""
    # in place: a slice of texts has a number for each of its bytes
    line = np.full(len(items) + 1, ODD)
    line[:2] = 1
    np.multiply.accumulate(line, out=line)
    line[1:] *= items
    line[0] = 0
    np.add.accumulate(line, out=line)
    total = line[end] - line[start]
    line.fill(pow(int(ODD), -1, 1 << 64))
    line[0] = 1
    np.multiply.accumulate(line, out=line)
    return mix(total * line[start] + (end - start).astype(np.uint64))


def window_runs(grams: np.ndarray, doc: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group the windows of ``length`` items by their owner: the leftmost of the smallest
    ``k``-gram hashes inside the window.  Equal windows have equal owners at equal offsets,
    so windows with different owner hashes never need to be compared.

    ``grams``: hash of the k-gram at each item; ``doc``: document number of each item (items of
    neighbouring documents lie side by side; windows across a border are left out).
    Returns the first window of each run of neighbouring windows with one owner, the number
    of windows in it, and the owner's position.
    """
    total = len(doc) - length + 1
    if total <= 0:
        return (np.empty(0, np.int64),) * 3
    span = length - k + 1
    low = np.uint64(0xFFFFFFFF)
    m = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if span > width:
        m = np.minimum(m[: len(m) - (span - width)], m[span - width :])
    at = np.flatnonzero(doc[:total] == doc[length - 1 :])
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    owner = (m[at] & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(owner) != 0)])
    return at[first], np.diff(np.r_[first, len(at)]), owner[first]


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    return start[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]]


def doc_batches(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of an Arrow batch in slices of about ``limit`` bytes, with the first row's number."""
    column = batch.column(batch.schema.get_field_index(text))
    start, size, rows = 0, 0, []
    for i, value in enumerate(column):
        value = value.as_py() or b""
        rows.append(value)
        size += len(value)
        if size >= limit:
            yield start, rows
            start, size, rows = i + 1, 0, []
    if rows:
        yield start, rows


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)
