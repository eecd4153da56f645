"""Language of texts: blended-spectrum string kernel, Nyström landmarks, one-versus-rest ridge regression.

A text is the set of its character n-grams of 1 to 4 characters, whole text, hashed into blocks
of fixed width.  The kernel of two texts is the sum over n of the shared n-grams divided by the
geometric mean of their numbers.  Kernel values against a few landmark texts are one matrix
product for a batch of texts; the regression on these values is fitted in closed form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.session import cut

#: landmark texts and texts learned from, over all languages (one of each language at least)
LANDMARKS, MAX_TRAINING = 96, 6_000
#: bits of the hash of each n-gram length; a text of 20,000 words leaves most of the longer blocks free
BITS = (8, 11, 13, 15)
OFFSETS = np.cumsum([0] + [1 << b for b in BITS])
RIDGE = 1e-3
#: texts in one matrix product; bytes hashed at a time
BATCH_TEXTS, BATCH_BYTES = 256, 1 << 20
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def _fold(text: bytes) -> np.ndarray:
    """Code points of the lower-cased text, one blank for every run of other characters than letters."""
    chars = np.frombuffer(text.decode("utf-8", "ignore").lower().encode("utf-32-le"), np.uint32)
    plain = ((chars >= 97) & (chars <= 122)) | (chars >= 0xAA)
    out = np.where(plain, chars, np.uint32(32))
    return out[np.r_[True, (out[1:] != 32) | (out[:-1] != 32)]] if len(out) else out


def presence(texts: list[bytes]) -> np.ndarray:
    """0/1 matrix of the hashed n-grams of each text."""
    out = np.zeros((len(texts), OFFSETS[-1]), np.float32)
    for row, text in zip(out, texts):
        text = b" " + text + b" "
        # a long text is read in pieces that overlap by the longest n-gram
        for a in range(0, len(text), BATCH_BYTES):
            chars = _fold(text[a : a + BATCH_BYTES + 4 * len(BITS)])
            h = np.zeros(len(chars), np.uint32)
            for n, bits in enumerate(BITS, 1):
                m = len(chars) - n + 1
                if m <= 0:
                    break
                h = h[:m] * np.uint32(_FACTORS[0]) + (chars[n - 1 :] + np.uint32(n)) * np.uint32(_FACTORS[1])
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(_FACTORS[2])
                row[OFFSETS[n - 1] + (mixed >> np.uint32(32 - bits)).astype(np.int64)] = 1
    return out


def kernel(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Blended-spectrum presence kernel of the rows of ``x`` with those of ``z``."""
    total = np.zeros((len(x), len(z)))
    for a, b in zip(OFFSETS[:-1], OFFSETS[1:]):
        p, q = x[:, a:b], z[:, a:b]
        total += (p @ q.T) / np.sqrt(np.maximum(p.sum(1), 1)[:, None] * np.maximum(q.sum(1), 1)[None, :])
    return total / len(BITS)


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _readable(text):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def _sample(docs: DataFrame, landmarks: int, most: int) -> DataFrame:
    """(text, lang, landmark): about the same number of texts of every language, those whose ids
    have the smallest hashes; at most ``most`` in all, but one of each language at least."""
    known = docs.where(~_held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & _readable("text")).select(
        "doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return None
    each = max(1, most // len(sizes))
    # a hash bound leaves few more rows than are wanted, so that ranking them is cheap
    bounds = [(r["lang"], min(int(1.5 * (each + 20) / r["n"] * 2**64) - 2**63, 2**63 - 1)) for r in sizes]
    limits = docs.sparkSession.createDataFrame(bounds, "lang string, most long")
    near = known.join(F.broadcast(limits), "lang").where("h <= most")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    first = near.withColumn("place", place).where(F.col("place") <= each)
    marks = max(1, landmarks // len(sizes))
    picked = cut(first.select("doc_id", F.col("lang").alias("__lang"), (F.col("place") <= marks).alias("landmark")))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.col("lang")).join(F.broadcast(picked), "doc_id")
    return texts.where("lang = __lang").select("text", "lang", "landmark")


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed presence bits of each landmark."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        bits = [np.packbits(presence([t or b""])[0] > 0).tobytes() for t in texts]
        yield pa.record_batch({"bits": pa.array(bits, pa.binary()), "lang": batch.column(1)})


def _normal_equations(marks: np.ndarray, langs: list[str]):
    """One row for each task: sums of k k' and k y' over its texts."""
    place = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(marks)
        z = np.unpackbits(marks, axis=1)[:, : OFFSETS[-1]].astype(np.float32)
        kk, ky = np.zeros((m, m)), np.zeros((m, len(langs)))
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(a, BATCH_TEXTS)
                k = kernel(presence([t or b"" for t in part.column(0).to_pylist()]), z)
                y = np.full((part.num_rows, len(langs)), -1.0)
                y[np.arange(part.num_rows), [place[x] for x in part.column(1).to_pylist()]] = 1
                kk += k.T @ k
                ky += k.T @ y
        yield pa.record_batch({"kk": pa.array([kk.tobytes()], pa.binary()), "ky": pa.array([ky.tobytes()], pa.binary())})
    return run


def fit(docs: DataFrame, landmarks: int = LANDMARKS, most: int = MAX_TRAINING):
    """Landmark bits, regression weights and language names; None without labelled texts."""
    sample = _sample(docs, landmarks, most)
    if sample is None:
        return None
    rows = sample.where("landmark").select("text", "lang").mapInArrow(_mark, "bits binary, lang string").dropDuplicates(["bits"]).toPandas()
    rows = rows.sort_values("bits").reset_index(drop=True)
    if not len(rows):
        return None
    marks = np.stack([np.frombuffer(b, np.uint8) for b in rows["bits"]])
    langs = sorted(sample.select("lang").distinct().toPandas()["lang"])
    sums = sample.select("text", "lang").repartition(16).mapInArrow(_normal_equations(marks, langs), "kk binary, ky binary").toPandas()
    m = len(marks)
    kk = sum(np.frombuffer(b, float).reshape(m, m) for b in sums["kk"])
    ky = sum(np.frombuffer(b, float).reshape(m, len(langs)) for b in sums["ky"])
    z = np.unpackbits(marks, axis=1)[:, : OFFSETS[-1]].astype(np.float32)
    kmm = kernel(z, z)
    n = max(1.0, float(np.trace(kk)) / max(float(np.trace(kmm)), 1e-9) * m)
    weights = np.linalg.lstsq(kk + RIDGE * n / m * kmm + 1e-8 * np.eye(m), ky, rcond=None)[0]
    return marks, weights, langs


def _predict(marks: np.ndarray, weights: np.ndarray, langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.unpackbits(marks, axis=1)[:, : OFFSETS[-1]].astype(np.float32)
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(a, BATCH_TEXTS)
                f = kernel(presence([t or b"" for t in part.column(1).to_pylist()]), z) @ weights
                best = f.argmax(1)
                readable = part.column(2).to_numpy(zero_copy_only=False)
                score = np.where(readable, np.clip((f.max(1) + 1) / 2, 0, 1), 0.0)
                yield pa.record_batch({
                    "doc_id": part.column(0), "lang_pred": pa.array([langs[b] if r else "und" for b, r in zip(best, readable)], pa.string()),
                    "score": pa.array(score)})
    return run


def identify(docs: DataFrame, landmarks: int = LANDMARKS, most: int = MAX_TRAINING) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs`` (doc_id, text, lang).

    Learned from at most ``most`` texts with a language whose crc32(doc_id as text) modulo 3 is
    not 1, evenly over the languages; ``landmarks`` of them carry the kernel.  Of every language, one
    text at least is learned from and one is a landmark, however many languages there are.  A prediction sees the text only.  ``score`` is the regression's
    best value mapped from [-1, 1] to [0, 1].  Null, empty and letterless texts give ``und`` with
    score 0, and so does every text when nothing is labelled.  Rows without doc_id are predicted,
    not learned from, and not held out.  Further columns are ignored.
    """
    docs = docs.select("doc_id", "text", "lang")
    model = fit(docs, landmarks, most)
    if model is None:
        return docs.select("doc_id", _held_out().alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), _readable("text").alias("readable"))
    found = rows.mapInArrow(_predict(*model), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")
