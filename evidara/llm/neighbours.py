"""Nearest neighbours by inner product: randomly rotated one-bit codes with error bounds.

A vector, less the centre of all vectors, is rotated at random and kept as the signs of its
coordinates, its length, and how well the signs point its way.  From these the inner product
with a query is estimated without bias and with a known spread; the mean over a few independent
rotations narrows it.  Vectors whose estimate plus its error bound reaches the score of the
query's k-th best so far are compared exactly.  The codes of a block are unpacked to signs, so
that estimating is one matrix product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.llm.common import stash

#: half width of the bound in standard deviations of the estimate
EPSILON = 4.0
#: independent rotations, each with one bit for a component
ROTATIONS = 4
#: vectors and queries that meet in one task; vectors and queries compared at a time
BLOCK_VECTORS, BLOCK_QUERIES = 16_384, 4_096
CHUNK_VECTORS, CHUNK_QUERIES = 2_048, 256
ROTATION_SEED = 11


def rotations(d: int) -> np.ndarray:
    """Random orthogonal matrices on top of each other, the same for a dimension."""
    out = []
    for seed in range(ROTATIONS):
        q, r = np.linalg.qr(np.random.default_rng([ROTATION_SEED, seed]).standard_normal((d, d)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length, and for each rotation the alignment (inner product of the unit vector and
    the unit signs)."""
    off = vectors - centre
    length = np.linalg.norm(off, axis=1)
    x = off @ turn.T
    d = len(centre)
    align = np.abs(x).reshape(len(x), -1, d).sum(2) / math.sqrt(d) / np.where(length > 0, length, 1)[:, None]
    return np.packbits(x > 0, axis=1), length, np.where(length[:, None] > 0, align, 1.0)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, one row for an id: neither null nor zero,
    no null or non-finite component, of the table's most common length (the smaller of two);
    of several vectors of one id the first in array order."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(good, F.lit(False)))
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1)
    first = sizes.first()
    rows = rows.where(F.size("embedding") == (first["d"] if first else -1))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def build_index(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, bits, length, align) for every usable vector; nothing is fitted but the
    centre, a mean over all of them."""
    vectors = stash(usable(vectors))
    mean = vectors.select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    centre = np.array([r["m"] for r in mean.orderBy("i").collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotations(len(centre))
        for batch in batches:
            if batch.num_rows:
                bits, length, align = encode(_matrix(batch.column(1)), centre, turn)
                yield pa.record_batch([*batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(align.tolist(), pa.list_(pa.float64()))],
                                      names=["vec_id", "embedding", "bits", "length", "align"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    index = stash(vectors.mapInArrow(run, f"vec_id long, embedding {kind}, bits binary, length double, align array<double>"))
    index.centre = centre
    return index


def _exact(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (q, v) of columns, added from the first component to the last."""
    total = np.zeros(len(q))
    for a, b in zip(queries, vectors):
        total += a.take(q) * b.take(v)
    return total


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each query, best first, ties to smaller ids."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    first = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[keep], score[keep]


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, bits: np.ndarray,
                 length: np.ndarray, align: np.ndarray, centre: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Numbers of the queries, ids and exact scores of the best ``k`` vectors of a block for each
    query, and how many were compared exactly."""
    d = len(centre)
    turned, base, size = (queries @ rotations(d).T).astype(np.float32), queries @ centre, np.linalg.norm(queries, axis=1)
    columns = np.ascontiguousarray(queries.T)
    floor = np.full(len(queries), -np.inf)
    found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    compared = 0
    scale = (length[:, None] / align / (ROTATIONS * math.sqrt(d))).astype(np.float32)
    # the part of a vector that its signs miss lies anyhow; its share in a direction has this spread
    spread = length * np.sqrt(((1 - np.minimum(align, 1) ** 2) / align**2).sum(1)) / ROTATIONS / math.sqrt(max(d - 1, 1))
    for a in range(0, len(ids), CHUNK_VECTORS):
        part = slice(a, a + CHUNK_VECTORS)
        signs = np.unpackbits(bits[part], axis=1)[:, : ROTATIONS * d].astype(np.float32) * 2 - 1
        signs = (signs.reshape(-1, ROTATIONS, d) * scale[part][:, :, None]).reshape(len(signs), -1)
        near = (turned @ signs.T) + base[:, None].astype(np.float32)
        top = near + (EPSILON * size).astype(np.float32)[:, None] * spread[part].astype(np.float32)[None, :]
        some = np.ascontiguousarray(vectors[part].T)
        own = query_ids[:, None] == ids[part][None, :]
        near[own] = top[own] = -np.inf
        # the best estimates first: their exact scores raise the bar for the rest
        m = min(2 * k, near.shape[1])
        likely = np.argpartition(-near, m - 1, axis=1)[:, :m]
        seen = np.zeros(near.shape, bool)
        np.put_along_axis(seen, likely, True, axis=1)
        for mask in (seen & ~own, None):
            if mask is None:
                mask = ~seen & ~own & (top >= floor[:, None])
            q, v = np.nonzero(mask)
            compared += len(q)
            found = _best(np.r_[found[0], q], np.r_[found[1], ids[part][v]], np.r_[found[2], _exact(columns, some, q, v)], k)
            full = np.flatnonzero(np.bincount(found[0], minlength=len(queries)) >= k)
            if len(full):
                floor[full] = found[2][np.searchsorted(found[0], full, "right") - 1]
    return *found, compared


def _search(centre: np.ndarray, k: int):
    def run(_, left, right):
        out = []
        if len(left) and len(right):
            vectors = np.stack(left["embedding"].to_list()).astype(np.float64)
            bits = np.frombuffer(b"".join(left["bits"]), np.uint8).reshape(len(left), -1)
            ids, length, align = left["vec_id"].to_numpy(), left["length"].to_numpy(), np.stack(left["align"].to_list())
            for a in range(0, len(right), CHUNK_QUERIES):
                some = right.iloc[a : a + CHUNK_QUERIES]
                names = some["query_id"].to_numpy()
                q, v, score, _ = search_block(np.stack(some["query"].to_list()).astype(np.float64), names, vectors, ids, bits, length, align, centre, k)
                out.append(pd.DataFrame({"query_id": names[q], "vec_id": v, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` its ``k``
    nearest among all others, by the largest inner product of the original vectors in double
    precision, ties to the smaller id.

    ``vectors`` has (vec_id, embedding); see :func:`usable` for the rows that take part.  Queries
    and vectors meet block by block; a task holds one block of each.  With fewer than ``k`` others
    all are returned; an empty table and one without queries give no rows.  The bound of
    ``EPSILON`` deviations leaves out a neighbour about once in 30,000.
    """
    index = build_index(vectors.select("vec_id", "embedding"))
    n = index.count()
    asked = index.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    kind = "query_id long, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vb, qb = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-asked.count() // BLOCK_QUERIES))
    left = index.withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.lit(vb))).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qb - 1).cast("long"))))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(qb))).withColumn("vb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(vb - 1).cast("long"))))
    met = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(_search(index.centre, k), kind)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
