"""Embedding analytics over (id, vec, label).

Sums over vectors are map-side aggregates.  What has one row per family or is a d × d
matrix comes to the driver after its size is checked; larger reference sets are visited
in blocks of fixed size, each exact, and the blocks' best are merged.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.operators.stats import counts_below
from evidara.ordering import row_numbers
from evidara.session import cut

BLOCK_VALUES = 8_000_000  # numbers per reference block (64 MB)
TILE_VALUES = 2_000_000  # distances a task holds at a time (16 MB)
TASK_PAIRS = 1 << 28  # distances that one task measures, about
STRIP = 64  # distances of which only the least is put in order at first


def unit(vec: Column) -> Column:
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return F.when(norm > 0, F.transform(vec, lambda x: x / norm)).otherwise(F.transform(vec, lambda x: x.cast("double")))


def measured(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Rows of ``df`` whose vector is there, not empty, and holds finite numbers only.  The others take no part in any
    operator of this module that measures distances or fits a model."""
    x = F.col(vec)
    return df.where(x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < math.inf)))


def mean_vectors(df: DataFrame, keys: Sequence[str], vec: str = "vec") -> DataFrame:
    got = df.groupBy(*keys).agg(Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>"))).alias("m"), F.count("*").alias("n"))
    return got.select(*keys, vector_to_array("m").alias(vec), "n")


def family_centroids(df: DataFrame, excluded: Sequence = ()) -> DataFrame:
    """(label, vec, n): mean vector per family scaled to length 1."""
    df = measured(df)
    rows = df.where(F.col("label").isNotNull() & ~F.col("label").isin(list(excluded))) if excluded else df.where("label IS NOT NULL")
    got = mean_vectors(rows, ["label"])
    return got.select("label", unit(F.col("vec")).alias("vec"), "n")


def width_of(df: DataFrame) -> int:
    row = df.select(F.size("vec").alias("d")).first()
    return int(row["d"]) if row else 0


def nearest(queries: DataFrame, refs: DataFrame, k: int, metric: str = "euclid", whiten: np.ndarray | None = None) -> DataFrame:
    """(id, ref, label, dist, rank): the k references nearest to every query, exact, ties
    by reference id.  ``queries``: id, vec; ``refs``: ref, label, vec.

    References that fit one block of ``BLOCK_VALUES`` numbers go to every task as a matrix.  More of
    them are dealt into blocks by their hash, queries meet every block in a task of its own,
    and the blocks' best are merged; no reference passes through the driver.  A task holds the distances of
    a few queries at a time, ``TILE_VALUES`` of them.  No references give no rows.
    Vectors that are not :func:`measured` are neither found nor given a row.
    """
    refs, queries = cut(measured(refs.select("ref", "label", "vec"))), cut(measured(queries).select(*[F.col(c).alias(c) for c in ("id", "vec")]))
    n, d, asked = refs.count(), max(1, width_of(refs)), queries.count()
    blocks = max(1, math.ceil(n * d / BLOCK_VALUES))
    schema = T.StructType([queries.schema["id"], T.StructField("ref", refs.schema["ref"].dataType),
                           T.StructField("label", refs.schema["label"].dataType), T.StructField("dist", T.DoubleType())])
    if not n:
        return queries.sparkSession.createDataFrame([], schema.add("rank", T.IntegerType()))

    def best(pdf: pd.DataFrame, m: np.ndarray, ids: list, labels: list) -> pd.DataFrame:
        every, names = prepare(np.stack([np.asarray(v, dtype=float) for v in pdf["vec"]]), metric, whiten), pdf["id"].tolist()
        square = (m * m).sum(axis=1)
        last, rows = min(k, m.shape[0]) - 1, max(1, TILE_VALUES // m.shape[0])
        out = []
        for first in range(0, len(every), rows):
            x = every[first : first + rows]
            dist = x @ m.T
            if metric == "cosine":
                np.subtract(1.0, dist, out=dist)
            else:
                dist *= -2.0
                dist += (x * x).sum(axis=1)[:, None] + square
                np.maximum(dist, 0.0, out=dist)
            bar = _at_least(dist, last)
            slack = 1e-9 * (1.0 + np.abs(bar))
            for i in range(len(x)):
                # everything that may tie with the k-th place is measured again exactly
                cand = np.flatnonzero(dist[i] <= bar[i] + slack[i])
                d2 = 1.0 - m[cand] @ x[i] if metric == "cosine" else np.sqrt(((m[cand] - x[i]) ** 2).sum(axis=1))
                for j in np.argsort(d2, kind="stable")[:k]:
                    out.append((names[first + i], ids[cand[j]], labels[cand[j]], float(d2[j])))
        return pd.DataFrame(out, columns=["id", "ref", "label", "dist"])

    def matrix(rows: pd.DataFrame) -> tuple[np.ndarray, list, list]:
        rows = rows.sort_values("ref")
        return prepare(np.stack([np.asarray(v, dtype=float) for v in rows["vec"]]), metric, whiten), rows["ref"].tolist(), rows["label"].tolist()

    if blocks == 1:
        ship = queries.sparkSession.sparkContext.broadcast(matrix(refs.toPandas()))

        def each(batches):
            for pdf in batches:
                if not pdf.empty:
                    yield best(pdf, *ship.value)

        parts = queries.repartition(max(1, min(asked, math.ceil(asked * n / TASK_PAIRS * 4)))).mapInPandas(each, schema)
    else:
        groups = max(1, math.ceil(asked * d / BLOCK_VALUES), math.ceil(asked * n / (blocks * TASK_PAIRS * 4)))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        all_ = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
        left = refs.withColumn("rb", F.pmod(F.xxhash64("ref"), F.lit(blocks))).withColumn("qb", all_)
        right = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(groups))).withColumn("rb", every)

        def meet(_, r, q):
            return best(q, *matrix(r)) if len(r) and len(q) else pd.DataFrame(columns=["id", "ref", "label", "dist"])

        parts = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInPandas(meet, schema)
    order = Window.partitionBy("id").orderBy("dist", "ref")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _at_least(dist: np.ndarray, last: int) -> np.ndarray:
    """For every row a number that is not below its value at place ``last``, and close to it: the value at that place among the least
    values of strips of the row, each of which is one of the row's own.  Rows of few strips are put in order themselves."""
    strips = dist.shape[1] // STRIP
    if strips <= 4 * (last + 1):
        return np.partition(dist, last, axis=1)[:, last]
    least = dist[:, : strips * STRIP].reshape(len(dist), STRIP, strips).min(axis=1)
    return np.partition(least, last, axis=1)[:, last]


def prepare(m: np.ndarray, metric: str, whiten: np.ndarray | None) -> np.ndarray:
    if metric == "cosine":
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norm > 0, norm, 1.0)
    return m @ whiten if whiten is not None else m


def nearest_family_cosine(queries: DataFrame, centroids: DataFrame) -> DataFrame:
    """(id, family, similarity) to the most similar centroid, ties by family."""
    got = nearest(queries, centroids.select(F.col("label").alias("ref"), "label", "vec"), 1, "cosine")
    return got.select("id", F.col("label").alias("family"), (1 - F.col("dist")).alias("similarity"))


def centered_moments(df: DataFrame, centroids: DataFrame) -> tuple[np.ndarray, int, float]:
    """(X'X, n, Σ‖x‖⁴) of the vectors minus their family mean.  Every partition sends one
    row per matrix row, which are summed by Spark; d rows reach the driver."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("row", T.ArrayType(T.DoubleType())),
                           T.StructField("n", T.LongType()), T.StructField("q", T.DoubleType())])

    def moments(batches):
        total, n, q = None, 0, 0.0
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack([np.asarray(v, dtype=float) - np.asarray(c, dtype=float) for v, c in zip(pdf["vec"], pdf["mean"])])
            total = x.T @ x if total is None else total + x.T @ x
            n += len(x)
            q += float(((x * x).sum(axis=1) ** 2).sum())
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total), dtype="int32"), "row": list(total), "n": [n] + [0] * (len(total) - 1), "q": [q] + [0.0] * (len(total) - 1)})

    joined = df.select("vec", "label").join(centroids.select("label", F.col("vec").alias("mean")), "label").select("vec", "mean")
    got = joined.mapInPandas(moments, schema).groupBy("i").agg(
        Summarizer.sum(array_to_vector("row")).alias("row"), F.sum("n").alias("n"), F.sum("q").alias("q")).orderBy("i").collect()
    return np.stack([r["row"].toArray() for r in got]), int(sum(r["n"] for r in got)), float(sum(r["q"] for r in got))


def shrinkage_precision(df: DataFrame) -> tuple[np.ndarray, float]:
    """(precision, shrinkage): Ledoit-Wolf covariance of the within-family centered
    vectors and its pseudo-inverse.  ``df``: vec, label; without a measured vector of a
    family the precision is an empty matrix and the shrinkage 0."""
    df = measured(df).where("label IS NOT NULL")
    if df.isEmpty():
        return np.zeros((0, 0)), 0.0
    xx, n, quad = centered_moments(df, mean_vectors(df, ["label"]))
    p = xx.shape[0]
    cov = xx / n
    mu = np.trace(cov) / p
    delta_raw = float((cov**2).sum())
    beta = (quad / n - delta_raw) / (p * n)
    delta = (delta_raw - 2 * mu * np.trace(cov) + p * mu**2) / p
    s = 0.0 if delta == 0 else min(beta, delta) / delta
    return np.linalg.pinv((1 - s) * cov + s * mu * np.eye(p)), float(s)


def whitening_matrix(precision: np.ndarray) -> np.ndarray:
    """W with W W' = precision, so that distances of x W are Mahalanobis distances."""
    return np.linalg.cholesky((precision + precision.T) / 2 + 1e-12 * np.eye(len(precision)))


def whiten_vectors(df: DataFrame, w: np.ndarray) -> DataFrame:
    """``df`` with vec times ``w``; a vector that is not :func:`measured` becomes null."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def times(v: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or not len(x) or not np.isfinite(y := np.asarray(x, dtype=float)).all() else y @ w for x in v],
                         index=v.index, dtype=object)

    return df.withColumn("vec", times("vec"))


def family_prototypes(df: DataFrame, k: int = 3, rounds: int = 10, seed: int = 0) -> DataFrame:
    """(label, proto, vec): k-means centers per family, the mean for families with fewer
    than ``k`` members.  All families move in the same pass over the data."""
    df = measured(df).where("label IS NOT NULL")
    sizes = df.groupBy("label").agg(F.count("*").alias("n"))
    big = cut(df.join(sizes.where(F.col("n") >= k).select("label"), "label", "left_semi").select("id", "label", "vec"))
    small = mean_vectors(df.join(sizes.where(F.col("n") < k).select("label"), "label", "left_semi"), ["label"])
    small = small.select("label", F.lit(0).alias("proto"), "vec")
    drawn = row_numbers(big.select("label", "id").withColumn("h", F.xxhash64("id", F.lit(seed))), ["label"], ["h", "id"], "place")
    start = drawn.where(F.col("place") <= k).select("label", "id", (F.col("place") - 1).cast("int").alias("proto"))
    centers = cut(big.join(start, ["label", "id"]).select("label", "proto", F.col("vec").cast("array<double>").alias("vec")))

    def settled(means: DataFrame) -> DataFrame:
        # rounded, as the order in which a mean is summed must not decide
        return means.select("label", "proto", F.transform("vec", lambda x: F.round(x, 12)).alias("vec"))

    for _ in range(rounds):
        # the few centers of a family travel with its members
        own = centers.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("proto", "vec"))).alias("own"))
        away = F.transform("own", lambda c: F.struct(F.aggregate(F.zip_with(F.col("vec"), c["vec"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x).alias("d"), c["proto"].alias("proto")))
        placed = big.withColumn("vec", F.col("vec").cast("array<double>")).join(own, "label").withColumn("proto", F.array_min(away)["proto"])
        centers = cut(settled(mean_vectors(placed, ["label", "proto"])))
    return centers.unionByName(settled(small))


def mahalanobis_assign(queries: DataFrame, prototypes: DataFrame, precision: np.ndarray) -> DataFrame:
    """(id, family, novelty): smallest squared Mahalanobis distance to any prototype."""
    refs = prototypes.select(F.concat_ws("#", F.col("label").cast("string"), F.col("proto").cast("string")).alias("ref"), "label", "vec")
    got = nearest(queries, refs, 1, "euclid", whitening_matrix(precision))
    return got.select("id", F.col("label").alias("family"), (F.col("dist") * F.col("dist")).alias("novelty"))


def family_envelope(candidates: DataFrame, members: DataFrame, keys: Sequence[str], value: str, limit: float = 95.0, least: int = 1) -> DataFrame:
    """(id, keys, percentile, inside): percent of the family's (or scope's) members
    strictly below the candidate; null where fewer than ``least`` members exist."""
    got = counts_below(candidates, members, keys, value)
    pct = F.when(F.col("n") >= least, F.col("below") / F.col("n") * 100)
    got = got.select(*keys, value, pct.alias("percentile"))
    return candidates.join(got, [*keys, value], "left").select("id", *keys, "percentile", (F.col("percentile") <= limit).alias("inside"))


def knn_novelty(queries: DataFrame, refs: DataFrame, k: int, whiten: np.ndarray | None = None) -> DataFrame:
    """(id, mean_dist, purity, top_family): mean distance to the k nearest references and
    the share of the most frequent family among them."""
    near = nearest(queries, refs, k, "euclid", whiten)
    votes = near.groupBy("id", "label").agg(F.count("*").alias("c"), F.sum("dist").alias("s"))
    got = votes.groupBy("id").agg(F.sum("c").alias("n"), F.sum("s").alias("s"), F.min(F.struct((-F.col("c")).alias("c"), "label")).alias("t"))
    return got.select("id", (F.col("s") / F.col("n")).alias("mean_dist"), (-F.col("t.c") / F.col("n")).alias("purity"), F.col("t.label").alias("top_family"))


def concat_fusion(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, vec): both models' vectors, each scaled to length 1, on the ids both have."""
    return a.select("id", unit(F.col("vec")).alias("__a")).join(b.select("id", unit(F.col("vec")).alias("__b")), "id").select(
        "id", F.concat("__a", "__b").alias("vec"))


def directions(n: int, width: int, seed: int = 0) -> np.ndarray:
    """n unit vectors; every entry comes from a hash of (seed, slice, place)."""
    def u(i: int, j: int) -> float:
        return int(hashlib.md5(f"{seed}|{i}|{j}".encode()).hexdigest()[:8], 16) / 4294967296.0 - 0.5

    m = np.array([[u(i, j) for j in range(width)] for i in range(n)])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def projections(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """(…, slice, value): every measured vector projected on ``n`` fixed directions."""
    df = measured(df)
    w = directions(n, width_of(df), seed).T

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(v: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack([np.asarray(x, dtype=float) for x in v]) @ w), index=v.index)

    return df.select(*[c for c in df.columns if c != "vec"], F.posexplode(project("vec")).alias("slice", "value"))


def swe_pooling(tokens: DataFrame, item: str, n_slices: int, points: Sequence[float], seed: int = 0) -> DataFrame:
    """(item, slice, q0, q1, …): quantiles of an item's token vectors along each direction;
    items with very many tokens are spread over tasks by the ordered scan."""
    from evidara.ordering import percentiles

    rows = projections(tokens.select(item, "vec"), n_slices, seed)
    return percentiles(rows, [item, "slice"], "value", {f"q{i}": p for i, p in enumerate(points)}).drop("n")


def composition_distance(queries: DataFrame, reference: DataFrame) -> DataFrame:
    """(id, dist): Euclidean distance of each composition vector to the reference mean."""
    center = mean_vectors(reference.select(F.lit(1).alias("k"), "vec"), ["k"]).select("vec").scalar()
    got = queries.select("id", "vec", center.alias("c"))
    return got.select("id", F.sqrt(F.aggregate(F.zip_with("vec", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)).alias("dist"))


def pca_projection(df: DataFrame, k: int) -> DataFrame:
    """(id, pcs): coordinates on the first k principal components of the centered vectors;
    each component's largest weight is made positive, so signs do not flip between runs."""
    from pyspark.ml.feature import PCA

    df = measured(df)
    mean = mean_vectors(df.select(F.lit(1).alias("g"), "vec"), ["g"]).select("vec").scalar()
    rows = cut(df.select("id", "vec", mean.alias("m")).select("id", array_to_vector(F.zip_with("vec", "m", lambda a, b: a.cast("double") - b)).alias("v")))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(rows)
    pc = model.pc.toArray()
    sign = np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(k)])
    flip = F.array(*[F.lit(float(s)) for s in sign])
    return model.transform(rows).select("id", F.zip_with(vector_to_array("p"), flip, lambda x, s: x * s).alias("pcs"))


def family_probe(train: DataFrame, queries: DataFrame, max_iter: int = 50, reg: float = 0.01) -> DataFrame:
    """(id, family, posterior): multinomial logistic classifier over the families."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer

    train, queries = measured(train).where("label IS NOT NULL"), measured(queries)
    rows = cut(train.select(F.col("label").cast("string").alias("family"), array_to_vector(F.col("vec").cast("array<double>")).alias("features")))
    names = StringIndexer(inputCol="family", outputCol="y", stringOrderType="alphabetAsc").fit(rows)
    model = LogisticRegression(labelCol="y", maxIter=max_iter, regParam=reg, family="multinomial").fit(names.transform(rows))
    got = model.transform(queries.select("id", array_to_vector(F.col("vec").cast("array<double>")).alias("features")))
    p = vector_to_array("probability")
    labels = F.array(*[F.lit(x) for x in names.labels])
    return got.select("id", F.get(labels, F.col("prediction").cast("int")).alias("family"), F.array_max(p).alias("posterior"))


def embedding_preflight(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """One row of checks: vectors, labels found for them, widths, shortest and longest norm."""
    have = vectors.join(labels.select("id").distinct().withColumn("__l", F.lit(1)), "id", "left")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return have.agg(
        F.count("*").alias("n_vectors"), F.count("__l").alias("n_labelled"), (F.count("__l") / F.count("*")).alias("label_share"),
        F.min(F.size("vec")).alias("min_width"), F.max(F.size("vec")).alias("max_width"), F.min(norm).alias("min_norm"), F.max(norm).alias("max_norm"))


def assignment_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """(id, before, after, delta, flipped) of two family assignments (id, family, novelty)."""
    a = before.select("id", F.col("family").alias("before"), F.col("novelty").alias("__a"))
    b = after.select("id", F.col("family").alias("after"), F.col("novelty").alias("__b"))
    return a.join(b, "id").select("id", "before", "after", (F.col("__b") - F.col("__a")).alias("delta"), (F.col("before") != F.col("after")).alias("flipped"))
