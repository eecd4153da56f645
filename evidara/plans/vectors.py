"""Embeddings: families 0 to 5 are the references, vectors of the other families are asked."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from evidara.functions import scalars as sc
from evidara.operators import vectors as vc
from evidara.plans.registry import query
from evidara.plans.scalars import _COMP
from evidara.plans.stats import rounded
from evidara.session import cut


def every(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vec"))


def refs(t):
    return every(t).where("label < 6")


def asked(t):
    return every(t).where("label >= 6")


V_SQL = """e AS (SELECT vec_id id, label, embedding::DOUBLE[] v FROM embeddings), x AS (SELECT id, label, unnest(v) x, generate_subscripts(v, 1) i FROM e),
mn AS (SELECT label, i, avg(x) m FROM x WHERE label < 6 GROUP BY 1, 2), nm AS (SELECT label, sqrt(sum(m * m)) n FROM mn GROUP BY 1),
ce AS (SELECT label, list(m / n ORDER BY i) c FROM mn JOIN nm USING (label) GROUP BY 1)"""


@query("family_centroids", f"WITH {V_SQL}, k AS (SELECT label, count(*) n FROM e WHERE label < 6 GROUP BY 1) SELECT mn.label, (i - 1)::INTEGER AS i, round(m / nm.n, 6) AS x, k.n FROM mn JOIN nm USING (label) JOIN k USING (label)")
def family_centroids(t):
    got = vc.family_centroids(refs(t))
    return got.select("label", "n", F.posexplode("vec").alias("i", "x")).select("label", "i", F.round("x", 6).alias("x"), "n")


@query("nearest_family_cosine", f"""
WITH {V_SQL}, s AS (SELECT id, ce.label, list_cosine_similarity(v, c) s FROM e, ce WHERE e.label >= 6), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, label) k FROM s)
SELECT id, label AS family, round(s, 6) AS similarity FROM r WHERE k = 1""")
def nearest_family_cosine(t):
    return rounded(vc.nearest_family_cosine(asked(t), vc.family_centroids(refs(t))), 6)


KNN_SQL = V_SQL + """, ds AS (SELECT q.id, r.id ref, r.label, list_distance(q.v, r.v) d FROM e q, e r WHERE q.label >= 6 AND r.label < 6), kn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, ref) k FROM ds)"""


@query("nearest_references", f"WITH {KNN_SQL} SELECT id, ref, label, round(d, 6) AS dist, k::INTEGER AS rank FROM kn WHERE k <= 5")
def nearest_references(t):
    return rounded(vc.nearest(asked(t), refs(t).withColumnRenamed("id", "ref"), 5), 6)


@query("knn_novelty", f"""
WITH {KNN_SQL}, c AS (SELECT id, label, count(*) c, sum(d) s FROM kn WHERE k <= 10 GROUP BY 1, 2) SELECT id, round(sum(s) / sum(c), 6) AS mean_dist, round(max(c) / sum(c), 9) AS purity, arg_min(label, (-c, label)) AS top_family FROM c GROUP BY 1""")
def knn_novelty(t):
    got = vc.knn_novelty(asked(t), refs(t).withColumnRenamed("id", "ref"), 10)
    return got.select("id", F.round("mean_dist", 6).alias("mean_dist"), F.round("purity", 9).alias("purity"), "top_family")


COV_SQL = V_SQL + """, cx AS (SELECT id, x.i, x - m x FROM x JOIN mn USING (label, i) WHERE label < 6), nn AS (SELECT count(*) n FROM e WHERE label < 6),
cv AS (SELECT a.i, b.i j, sum(a.x * b.x) / max(n) s FROM cx a JOIN cx b USING (id), nn GROUP BY 1, 2), q AS (SELECT sum(z * z) q FROM (SELECT id, sum(x * x) z FROM cx GROUP BY 1)),
w AS (SELECT sum(s) FILTER (i = j) tr, sum(s * s) ss, count(*) FILTER (i = j) p FROM cv)"""


@query("shrinkage_precision", f"""
WITH {COV_SQL} SELECT round(least((q / n - ss) / (p * n), (ss - tr * tr / p) / p) / ((ss - tr * tr / p) / p), 6) AS shrinkage, n, round(tr / p, 9) AS mean_variance FROM w, q, nn""")
def shrinkage_precision(t):
    r = cut(refs(t))
    xx, n, _ = vc.centered_moments(r, vc.mean_vectors(r, ["label"]))
    _, s = vc.shrinkage_precision(r)
    return t.spark.createDataFrame([(round(s, 6), n, round(float(np.trace(xx)) / n / len(xx), 9))], "shrinkage double, n long, mean_variance double")


def model(t):
    r = cut(refs(t))
    precision, _ = vc.shrinkage_precision(r)
    protos = vc.mean_vectors(r, ["label"]).select("label", F.lit(0).alias("proto"), "vec")
    return r, precision, cut(protos)


@query("mahalanobis_assign")
def mahalanobis_assign(t):
    _, precision, protos = model(t)
    return rounded(vc.mahalanobis_assign(asked(t), protos, precision), 6)


@query("family_prototypes")
def family_prototypes(t):
    got = vc.family_prototypes(refs(t), 3, 5)
    return got.select("label", "proto", F.posexplode("vec").alias("i", "x")).select("label", "proto", "i", F.round("x", 6).alias("x"))


@query("whitening")
def whitening(t):
    _, precision, _ = model(t)
    got = vc.whiten_vectors(asked(t).select("id", "vec"), vc.whitening_matrix(precision))
    return got.select("id", F.posexplode("vec").alias("i", "x")).select("id", "i", F.round("x", 6).alias("x"))


ENV_SQL = V_SQL + """, dd AS (SELECT e.id, e.label lab, ce.label, round(list_distance(v, c), 6) d, row_number() OVER (PARTITION BY e.id ORDER BY list_distance(v, c), ce.label) k FROM e, ce),
mb AS (SELECT e.id, e.label, round(list_distance(v, c), 6) d FROM e JOIN ce USING (label)), ca AS (SELECT id, label, d FROM dd WHERE k = 1 AND lab >= 6)"""


def distances(t):
    ce = cut(vc.family_centroids(refs(t)).select(F.col("label").alias("ref"), "label", "vec"))
    cand = vc.nearest(asked(t), ce, 1).select("id", "label", F.round("dist", 6).alias("d"))
    own = refs(t).join(ce.select("label", F.col("vec").alias("c")), "label")
    mem = own.select("id", "label", F.round(F.sqrt(F.aggregate(F.zip_with("vec", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)), 6).alias("d"))
    return cut(cand), cut(mem)


@query("family_envelope", f"""
WITH {ENV_SQL} SELECT c.id, c.label, round(count(*) FILTER (m.d < c.d) / count(*) * 100, 6) AS percentile, count(*) FILTER (m.d < c.d) / count(*) * 100 <= 95 AS inside FROM ca c JOIN mb m USING (label) GROUP BY 1, 2""")
def family_envelope(t):
    cand, mem = distances(t)
    return rounded(vc.family_envelope(cand, mem, ["label"], "d"), 6)


@query("null_envelope", f"""
WITH {ENV_SQL}, sc AS (SELECT 'all' scope UNION ALL SELECT 'low' UNION ALL SELECT 'tiny'), nl AS (SELECT scope, m.d FROM mb m, sc WHERE scope = 'all' OR (scope = 'low' AND label < 5) OR (scope = 'tiny' AND id < 10))
SELECT c.id, scope, CASE WHEN count(*) >= 30 THEN round(count(*) FILTER (n.d < c.d) / count(*) * 100, 6) END AS percentile, CASE WHEN count(*) >= 30 THEN count(*) FILTER (n.d < c.d) / count(*) * 100 <= 95 END AS inside
FROM ca c, nl n GROUP BY 1, 2""")
def null_envelope(t):
    cand, mem = distances(t)
    tag = F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("label") < 5, "low"), F.when(F.col("id") < 10, "tiny"))))
    scopes = cand.select("id", "d", F.explode(F.array(F.lit("all"), F.lit("low"), F.lit("tiny"))).alias("scope"))
    return rounded(vc.family_envelope(scopes, mem.select("d", tag.alias("scope")), ["scope"], "d", least=30), 6)


@query("label_variants", f"""
WITH e AS (SELECT vec_id id, label, embedding::DOUBLE[] v FROM embeddings), l AS (SELECT id, v, 'drop' variant, label FROM e WHERE label <> 3 AND label < 6 UNION ALL SELECT id, v, 'merge', CASE WHEN label = 4 THEN 5 ELSE label END FROM e WHERE label < 6),
x AS (SELECT id, variant, label, unnest(v) x, generate_subscripts(v, 1) i FROM l), m AS (SELECT variant, label, i, avg(x) m FROM x GROUP BY 1, 2, 3), n AS (SELECT variant, label, sqrt(sum(m * m)) n FROM m GROUP BY 1, 2),
c AS (SELECT variant, label, list(m / n ORDER BY i) c FROM m JOIN n USING (variant, label) GROUP BY 1, 2), s AS (SELECT variant, id, c.label, row_number() OVER (PARTITION BY variant, id ORDER BY list_cosine_similarity(v, c) DESC, c.label) k FROM e, c WHERE e.label >= 6)
SELECT variant, id, label AS family FROM s WHERE k = 1""")
def label_variants(t):
    r = refs(t)
    drop = vc.nearest_family_cosine(asked(t), vc.family_centroids(r, [3])).select(F.lit("drop").alias("variant"), "id", "family")
    merged = r.withColumn("label", F.when(F.col("label") == 4, 5).otherwise(F.col("label")))
    return drop.unionByName(vc.nearest_family_cosine(asked(t), vc.family_centroids(merged)).select(F.lit("merge").alias("variant"), "id", "family"))


HALF_SQL = V_SQL + """, hv AS (SELECT id, label, v[1:32] a, v[33:64] b FROM e), hc AS (SELECT label, c[1:32] a, c[33:64] b FROM ce),
ra AS (SELECT hv.id, hc.label, row_number() OVER (PARTITION BY hv.id ORDER BY list_cosine_similarity(hv.a, hc.a) DESC, hc.label) k FROM hv, hc WHERE hv.label >= 6),
rb AS (SELECT hv.id, hc.label, row_number() OVER (PARTITION BY hv.id ORDER BY list_cosine_similarity(hv.b, hc.b) DESC, hc.label) k FROM hv, hc WHERE hv.label >= 6)"""


def half(df, start):
    return df.withColumn("vec", F.slice("vec", start, 32))


@query("model_disagreement", f"WITH {HALF_SQL} SELECT ra.id, ra.label AS model_a, rb.label AS model_b, ra.label = rb.label AS agree FROM ra JOIN rb USING (id) WHERE ra.k = 1 AND rb.k = 1")
def model_disagreement(t):
    ce = cut(vc.family_centroids(refs(t)))
    a = vc.nearest_family_cosine(half(asked(t), 1), half(ce, 1)).select("id", F.col("family").alias("model_a"))
    b = vc.nearest_family_cosine(half(asked(t), 33), half(ce, 33)).select("id", F.col("family").alias("model_b"))
    return a.join(b, "id").withColumn("agree", F.col("model_a") == F.col("model_b"))


@query("leave_in_out_novelty", f"""
WITH {V_SQL}, s AS (SELECT id, ce.label, list_distance(v, c) d FROM e, ce WHERE e.label >= 6), w AS (SELECT id, label, d, row_number() OVER (PARTITION BY id ORDER BY d, label) k FROM s), o AS (SELECT id, label, d, row_number() OVER (PARTITION BY id ORDER BY d, label) k FROM s WHERE label <> 4)
SELECT w.id, o.label AS before, w.label AS after, round(w.d - o.d, 6) AS delta, w.label <> o.label AS flipped FROM w JOIN o USING (id) WHERE w.k = 1 AND o.k = 1""")
def leave_in_out_novelty(t):
    ce = cut(vc.family_centroids(refs(t)).select(F.col("label").alias("ref"), "label", "vec"))
    q = asked(t)
    pick = lambda c: vc.nearest(q, c, 1).select("id", F.col("label").alias("family"), F.col("dist").alias("novelty"))
    return rounded(vc.assignment_change(pick(ce.where("label <> 4")), pick(ce)), 6)


@query("concat_fusion", """
WITH e AS (SELECT vec_id id, label, embedding::DOUBLE[] v FROM embeddings), n AS (SELECT id, label, v, sqrt(list_dot_product(v[1:32], v[1:32])) a, sqrt(list_dot_product(v[33:64], v[33:64])) b FROM e), x AS (SELECT id, label, unnest(v) x, generate_subscripts(v, 1) i, a, b FROM n)
SELECT id, (i - 1)::INTEGER AS i, round(x / CASE WHEN i <= 32 THEN a ELSE b END, 6) AS x FROM x WHERE label <> 3""")
def concat_fusion(t):
    got = vc.concat_fusion(half(every(t), 1), half(every(t).where("label <> 3"), 33))
    return got.select("id", F.posexplode("vec").alias("i", "x")).select("id", "i", F.round("x", 6).alias("x"))


def _dir_sql(n, width):
    d = vc.directions(n, width)
    return ", ".join(f"({i}, [{', '.join(repr(float(x)) for x in row)}]::DOUBLE[])" for i, row in enumerate(d))


@query("swe_pooling", f"""
WITH d AS (SELECT * FROM (VALUES {_dir_sql(3, 64)}) t(s, w)), p AS (SELECT label, s, list_dot_product(embedding::DOUBLE[], w) x FROM embeddings, d)
SELECT label, s AS slice, round(quantile_cont(x, 0.1), 6) AS q0, round(quantile_cont(x, 0.5), 6) AS q1, round(quantile_cont(x, 0.9), 6) AS q2 FROM p GROUP BY 1, 2""")
def swe_pooling(t):
    return rounded(vc.swe_pooling(every(t), "label", 3, [0.1, 0.5, 0.9]), 6)


@query("composition_distance", f"""
WITH c AS (SELECT doc_id, [{_COMP}] v FROM documents), x AS (SELECT doc_id, unnest(v) / CASE WHEN list_sum(v) > 0 THEN list_sum(v) ELSE 1 END x, unnest(range(20)) i FROM c),
m AS (SELECT i, avg(x) m FROM x WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY 1) SELECT doc_id AS id, round(sqrt(sum((x - m) * (x - m))), 9) AS dist FROM x JOIN m USING (i) GROUP BY 1""")
def composition_distance(t):
    d = cut(t.documents.select(F.col("doc_id").alias("id"), sc.aa_composition(F.col("text")).alias("vec")))
    ref = d.join(t.labels.where("quality = 1").select(F.col("doc_id").alias("id")), "id", "left_semi")
    return rounded(vc.composition_distance(d, ref))


@query("pca_projection")
def pca_projection(t):
    got = vc.pca_projection(every(t).select("id", "vec"), 2)
    return got.select("id", F.round(F.get("pcs", F.lit(0)), 6).alias("pc1"), F.round(F.get("pcs", F.lit(1)), 6).alias("pc2"))


@query("family_probe")
def family_probe(t):
    return rounded(vc.family_probe(refs(t), asked(t)), 4)


@query("embedding_preflight", """
WITH n AS (SELECT vec_id, label, len(embedding) d, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) n FROM embeddings)
SELECT count(*) AS n_vectors, count(*) FILTER (label < 7) AS n_labelled, round(count(*) FILTER (label < 7) / count(*), 9) AS label_share, min(d)::INTEGER AS min_width, max(d)::INTEGER AS max_width, round(min(n), 6) AS min_norm, round(max(n), 6) AS max_norm FROM n""")
def embedding_preflight(t):
    got = vc.embedding_preflight(every(t), every(t).where("label < 7"))
    return got.select(*[F.round(c, 9 if c == "label_share" else 6).alias(c) if d == "double" else F.col(c) for c, d in got.dtypes])
