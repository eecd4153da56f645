"""Tests, calibration and resampling over orders, customers and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.functions.seats import seats_sql
from evidara.operators import fusion as fu
from evidara.operators import stats as st
from evidara.operators.evidence import merge_selection_signals
from evidara.ordering import row_numbers
from evidara.plans.bindings import RANKS_SQL, SIGNAL_NAMES, VOTES_SQL
from evidara.plans.fusion import votes
from evidara.plans.registry import query
from evidara.session import cut


def rounded(df, digits=9):
    return df.select(*[F.round(c, digits).alias(c) if d == "double" else F.col(c) for c, d in df.dtypes])


def hash_sql(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def uniform_sql(*parts: str) -> str:
    return f"(('0x' || substr({hash_sql(*parts)}, 1, 8))::BIGINT / 4294967296.0)"


P_SQL = "p AS (SELECT o_orderkey id, o_orderpriority pool, o_totalprice / 600000 AS p FROM orders)"


@query("benjamini_hochberg", f"""
WITH {P_SQL}, r AS (SELECT *, p * count(*) OVER (PARTITION BY pool) / row_number() OVER (PARTITION BY pool ORDER BY p, id) raw,
 row_number() OVER (PARTITION BY pool ORDER BY p, id) k FROM p)
SELECT id, pool, round(least(1.0, min(raw) OVER (PARTITION BY pool ORDER BY k DESC)), 9) AS q FROM r""")
def benjamini_hochberg(t):
    p = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("pool"), (F.col("o_totalprice") / 600000).alias("p"))
    return rounded(st.benjamini_hochberg(p, "p", "q", ["pool"]).select("id", "pool", "q"))


@query("absrel_fdr_merge", """
WITH r AS (SELECT l_partkey branch_id, l_orderkey * 10 + l_linenumber pos, l_returnflag = 'A' done, l_extendedprice / 120000 p, l_discount cp FROM lineitem),
u AS (SELECT *, row_number() OVER (ORDER BY p, pos) k, count(*) OVER () n FROM r WHERE NOT done),
q AS (SELECT branch_id, pos, least(1.0, min(p * n / k) OVER (ORDER BY k DESC)) c, 0 rk FROM u UNION ALL SELECT branch_id, pos, cp, 1 FROM r WHERE done),
w AS (SELECT branch_id, arg_max(c, rk * 1000000000 + pos) c FROM q GROUP BY 1)
SELECT branch_id, round(c, 9) AS corrected_p, c < 0.05 AS significant FROM w""")
def absrel_fdr_merge(t):
    rows = t.lineitem.select(
        F.col("l_partkey").alias("branch_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.col("l_quantity").alias("omega"), F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("is_already_corrected"),
        (F.col("l_extendedprice") / 120000).alias("p_value"), F.col("l_discount").alias("corrected_p_value"))
    return rounded(st.absrel_fdr_merge(rows))


@query("selection_signal_merge", """
WITH a AS (SELECT l_orderkey og, min(l_tax) gene_wide_p FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
b AS (SELECT l_orderkey og, min(l_tax) multi_hit_p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
c AS (SELECT l_orderkey og, count(*) n_sites FROM lineitem WHERE l_discount > 0.05 GROUP BY 1)
SELECT og, gene_wide_p, coalesce(gene_wide_p < 0.03, false) AS gene_wide_significant, multi_hit_p, coalesce(multi_hit_p < 0.03, false) AS multi_hit_significant,
 coalesce(n_sites, 0) AS n_sites FROM a FULL JOIN b USING (og) FULL JOIN c USING (og)""")
def selection_signal_merge(t):
    def best(flag, name):
        return t.lineitem.where(F.col("l_returnflag") == flag).groupBy(F.col("l_orderkey").alias("og")).agg(F.min("l_tax").alias(name))

    sites = t.lineitem.where("l_discount > 0.05").groupBy(F.col("l_orderkey").alias("og")).agg(F.count("*").alias("n_sites"))
    return merge_selection_signals(best("A", "gene_wide_p"), best("R", "multi_hit_p"), sites, "og", 0.03)


@query("lrt_pvalue", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity - 20 <= 0 THEN 1 ELSE exp(-(l_quantity - 20) / 2) END, 12) AS p_value,
 round(CASE WHEN l_quantity - 20 <= 0 THEN 1 ELSE 0.5 * exp(-(l_quantity - 20) / 2) * (1 + (l_quantity - 20) / 2) END, 12) AS p_boundary FROM lineitem""")
def lrt_pvalue(t):
    x = F.col("l_quantity") - 20
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(st.lrt_pvalue(x, 2), 12).alias("p_value"),
                             F.round(st.lrt_pvalue(x, 4, True), 12).alias("p_boundary"))


@query("mann_whitney", """
WITH r AS (SELECT l_returnflag pool, l_linestatus = 'F' a, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
  + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 rk, count(*) OVER (PARTITION BY l_returnflag, l_quantity) tn FROM lineitem),
s AS (SELECT pool, count(*) FILTER (a) na, count(*) FILTER (NOT a) nb, sum(rk) FILTER (a) ra, count(*)::DOUBLE n, sum(tn * tn - 1.0) tie FROM r GROUP BY 1),
u AS (SELECT *, ra - na * (na + 1) / 2 u FROM s)
SELECT pool, na AS n_a, nb AS n_b, u, round((greatest(u, na * nb - u) - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * ((n + 1) - tie / (n * (n - 1)))), 9) AS z,
 round(2 * u / (na * nb) - 1, 9) AS rank_biserial FROM u""")
def mann_whitney(t):
    got = st.mann_whitney(t.lineitem.withColumnRenamed("l_returnflag", "pool"), "l_quantity", F.col("l_linestatus") == "F", ["pool"])
    return rounded(got)


CONF_SQL = """v AS (SELECT doc_id id, n_chars, length(text) - length(replace(text, ' ', '')) words, length(regexp_replace(text, '[^aeiou]', '', 'g')) vowels,
  length(text) - length(replace(text, 'e', '')) es FROM documents),
r AS (SELECT id, """ + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 {a}"
    for c, a in (("n_chars", "a"), ("words", "b"), ("vowels", "y"), ("es", "z"))
) + " FROM v)"


def doc_measures(t):
    text = F.col("text")
    return t.documents.select(
        F.col("doc_id").alias("id"), F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("double").alias("words"),
        F.length(F.regexp_replace(text, "[^aeiou]", "")).cast("double").alias("vowels"),
        (F.length(text) - F.length(F.replace(text, F.lit("e"), F.lit("")))).cast("double").alias("es"))


_FIT = """m AS (SELECT avg(a) ma, avg(b) mb, avg(y) my, avg(z) mz, covar_pop(a, a) aa, covar_pop(b, b) bb, covar_pop(a, b) ab,
 covar_pop(a, y) ay, covar_pop(b, y) bby, covar_pop(a, z) az, covar_pop(b, z) bz FROM r)"""


@query("confound_residuals", f"""
WITH {CONF_SQL}, {_FIT}
SELECT id, round(y - my - (ay * bb - bby * ab) / (aa * bb - ab * ab) * (a - ma) - (bby * aa - ay * ab) / (aa * bb - ab * ab) * (b - mb), 5) AS residual FROM r, m""")
def confound_residuals(t):
    return rounded(st.confound_residuals(doc_measures(t), "vowels", ["n_chars", "words"]), 5)


@query("residual_independence", f"""
WITH {CONF_SQL}, {_FIT}, e AS (SELECT id, round(y - my - (ay * bb - bby * ab) / (aa * bb - ab * ab) * (a - ma) - (bby * aa - ay * ab) / (aa * bb - ab * ab) * (b - mb), 5) e1,
 round(z - mz - (az * bb - bz * ab) / (aa * bb - ab * ab) * (a - ma) - (bz * aa - az * ab) / (aa * bb - ab * ab) * (b - mb), 5) e2 FROM r, m),
k AS (SELECT rank() OVER (ORDER BY e1) + (count(*) OVER (PARTITION BY e1) - 1) / 2.0 k1, rank() OVER (ORDER BY e2) + (count(*) OVER (PARTITION BY e2) - 1) / 2.0 k2 FROM e)
SELECT 'es' AS a, 'vowels' AS b, count(*) AS n, round(corr(k1, k2), 6) AS rho, abs(corr(k1, k2)) < 0.7 AS independent FROM k""")
def residual_independence(t):
    d = cut(doc_measures(t))
    one = rounded(st.confound_residuals(d, "vowels", ["n_chars", "words"]), 5).select("id", F.lit("vowels").alias("signal"), F.col("residual").alias("value"))
    two = rounded(st.confound_residuals(d, "es", ["n_chars", "words"]), 5).select("id", F.lit("es").alias("signal"), F.col("residual").alias("value"))
    got = st.pair_correlations(one.unionByName(two))
    return got.select("a", "b", "n", F.round("rho", 6).alias("rho"), (F.abs("rho") < 0.7).alias("independent"))


@query("confound_report", f"""
WITH {CONF_SQL}, c AS (SELECT corr(y, a) ra, count(*) n FROM r), q AS (SELECT quantile_cont(es, 0.33) t FROM v),
lo AS (SELECT rank() OVER (ORDER BY vowels) + (count(*) OVER (PARTITION BY vowels) - 1) / 2.0 k1, rank() OVER (ORDER BY es) + (count(*) OVER (PARTITION BY es) - 1) / 2.0 k2 FROM v, q WHERE es <= t),
l AS (SELECT count(*) n, corr(k1, k2) r FROM lo), g AS (SELECT corr(y, z) rz FROM r)
SELECT 'n_chars' AS confound, 'artifact' AS role, n, round(ra, 6) AS spearman, NULL::BIGINT AS low_n, NULL::DOUBLE AS low_spearman,
 CASE WHEN abs(ra) > 0.4 THEN 'artifact-confound' ELSE 'clean' END AS verdict FROM c
UNION ALL SELECT 'es', 'redundancy', (SELECT n FROM c), round(rz, 6), l.n, round(l.r, 6),
 CASE WHEN abs(rz) > 0.85 THEN 'redundant-with-identity' WHEN abs(l.r) > 0.4 THEN 'low-identity-artifact' ELSE 'adds-value' END FROM g, l""")
def confound_report(t):
    return rounded(st.confound_report(doc_measures(t), "vowels", {"n_chars": "artifact", "es": "redundancy"}), 6)


PAIRS_SQL = VOTES_SQL + """, pr AS (SELECT x.signal a, y.signal b, x.value va, y.value vb FROM votes x JOIN votes y USING (id) WHERE x.signal < y.signal),
k AS (SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY va) + (count(*) OVER (PARTITION BY a, b, va) - 1) / 2.0 k1,
 rank() OVER (PARTITION BY a, b ORDER BY vb) + (count(*) OVER (PARTITION BY a, b, vb) - 1) / 2.0 k2 FROM pr),
pairs AS (SELECT a, b, count(*) n, round(corr(k1, k2), 6) rho FROM k GROUP BY 1, 2)"""


@query("signal_redundancy", f"WITH {PAIRS_SQL} SELECT a, b, n, rho, abs(rho) >= 0.7 AS flagged FROM pairs")
def signal_redundancy(t):
    got = st.pair_correlations(votes(t))
    return got.select("a", "b", "n", F.round("rho", 6).alias("rho"), (F.abs(F.round("rho", 6)) >= 0.7).alias("flagged"))


@query("signal_groups", f"""
WITH RECURSIVE {PAIRS_SQL}, e AS (SELECT a, b FROM pairs WHERE abs(rho) >= 0.7 UNION SELECT b, a FROM pairs WHERE abs(rho) >= 0.7),
reach AS (SELECT DISTINCT signal node, signal r FROM votes UNION SELECT reach.node, e.b FROM reach JOIN e ON e.a = reach.r)
SELECT node, min(r) AS component FROM reach GROUP BY 1""")
def signal_groups(t):
    v = cut(votes(t))
    pairs = st.pair_correlations(v).where(F.abs(F.round("rho", 6)) >= 0.7)
    return st.connected_components(pairs.select("a", "b"), v.select(F.col("signal").alias("node")).distinct())


def order_components(t):
    """Orders that share a (part, supplier) pair belong together."""
    lines = t.lineitem.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("a"),
                              F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit("s"), F.col("l_suppkey").cast("string")).alias("b"))
    return lines


@query("percentile_summary", """
WITH g AS (SELECT o_custkey, max(o_totalprice) m FROM orders GROUP BY 1)
SELECT count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS p75,
 round(quantile_cont(o_totalprice, 0.9), 4) AS p90, round(quantile_cont(o_totalprice, 0.95), 4) AS p95, round(quantile_cont(o_totalprice, 0.99), 4) AS p99,
 (SELECT round(avg(m), 4) FROM g) AS group_max_mean, (SELECT round(quantile_cont(m, 0.95), 4) FROM g) AS group_max_p95 FROM orders""")
def percentile_summary(t):
    return rounded(st.percentile_summary(t.orders, "o_custkey", "o_totalprice"), 4)


@query("empirical_pvalue", """
WITH o AS (SELECT o_custkey k, max(o_totalprice) v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
n AS (SELECT o_custkey k, o_totalprice x FROM orders WHERE o_orderstatus <> 'F'),
s AS (SELECT k, max(v) v, count(*) FILTER (x >= v) b, count(*) m, avg(x) mu, stddev_pop(x) sd FROM n JOIN o USING (k) GROUP BY 1)
SELECT k, round((b + 1) / (m + 1), 9) AS p_value, round(mu, 6) AS null_mean, round(sd, 4) AS null_std,
 CASE WHEN sd = 0 THEN CASE WHEN v <= mu THEN 0 ELSE 'inf'::DOUBLE END ELSE round((v - mu) / sd, 6) END AS excess, v <= mu AS collapsed FROM s""")
def empirical_pvalue(t):
    obs = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("value"))
    null = t.orders.where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("null_value"))
    got = st.empirical_pvalue(obs, null, ["k"])
    return got.select("k", F.round("p_value", 9).alias("p_value"), F.round("null_mean", 6).alias("null_mean"), F.round("null_std", 4).alias("null_std"),
                      F.round("excess", 6).alias("excess"), "collapsed")


@query("conformal_pvalues", """
WITH c AS (SELECT o_orderpriority k, o_totalprice v FROM orders WHERE o_orderstatus = 'F'),
p AS (SELECT o_orderkey id, o_orderpriority k, o_totalprice v FROM orders WHERE o_orderstatus <> 'F'),
s AS (SELECT k, v, NULL id FROM c UNION ALL SELECT k, v, id FROM p),
w AS (SELECT *, count(*) FILTER (id IS NULL) OVER (PARTITION BY k ORDER BY v DESC RANGE UNBOUNDED PRECEDING) ge, count(*) FILTER (id IS NULL) OVER (PARTITION BY k) n FROM s)
SELECT id, k, round((1 + ge) / (n + 1), 9) AS p FROM w WHERE id IS NOT NULL""")
def conformal_pvalues(t):
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"), "o_orderstatus")
    return rounded(st.conformal_pvalues(o.where("o_orderstatus <> 'F'"), o.where("o_orderstatus = 'F'"), "id", "v", ["k"]))


@query("evalue_threshold", """
WITH r AS (SELECT l_returnflag truth, CASE WHEN l_extendedprice > 4000 THEN l_returnflag WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END predicted, l_extendedprice / 1e6 e FROM lineitem),
n AS (SELECT truth f, count(*) n FROM r GROUP BY 1),
h AS (SELECT predicted f, e, count(*) FILTER (truth = predicted) tp, count(*) FILTER (truth <> predicted) fp FROM r GROUP BY 1, 2),
w AS (SELECT h.f, e, tp, n, sum(tp) OVER (PARTITION BY h.f ORDER BY e) ctp, sum(fp) OVER (PARTITION BY h.f ORDER BY e) cfp FROM h JOIN n USING (f)),
k AS (SELECT *, ctp / (ctp + cfp) >= 0.95 AND ctp / n >= 0.9 ok FROM w WHERE tp > 0 AND ctp >= greatest(1, floor(0.9 * n + 0.999))),
x AS (SELECT f, min(e) FILTER (NOT ok) bad FROM k GROUP BY 1), b AS (SELECT f, max(e) t FROM k JOIN x USING (f) WHERE bad IS NULL OR e < bad GROUP BY 1)
SELECT n.f AS family, coalesce(t, 1e-20) AS threshold FROM n LEFT JOIN b USING (f)""")
def evalue_threshold(t):
    pred = F.when(F.col("l_extendedprice") > 4000, F.col("l_returnflag")).when(F.col("l_linestatus") == "F", "A").otherwise("N")
    return st.evalue_threshold(t.lineitem.select(F.col("l_returnflag").alias("truth"), pred.alias("predicted"), (F.col("l_extendedprice") / 1e6).alias("evalue")))


def margins(t):
    m = F.round(F.col("l_extendedprice") / 10000 + F.when(F.col("l_returnflag") == "A", 3.0).otherwise(0.0), 3)
    lone = F.col("l_quantity") >= 49
    rows = t.lineitem.select(F.when(lone, float("inf")).otherwise(m).alias("margin"), "l_returnflag")
    return rows.where("l_returnflag = 'A'"), rows.where("l_returnflag <> 'A' AND margin < double('infinity')")


MARGIN_SQL = """x AS (SELECT CASE WHEN l_quantity >= 49 THEN 'inf'::DOUBLE ELSE round(l_extendedprice / 10000 + CASE WHEN l_returnflag = 'A' THEN 3.0 ELSE 0 END, 3) END m,
 l_returnflag = 'A' tp FROM lineitem), tp AS (SELECT m FROM x WHERE tp AND m < 'inf'), fp AS (SELECT m FROM x WHERE NOT tp AND m < 'inf'),
g AS (SELECT round(i * 0.1::DOUBLE, 4) AS m FROM generate_series(0, (SELECT round((max(m) + 0.1) / 0.1)::BIGINT FROM (SELECT m FROM tp UNION ALL SELECT m FROM fp))) s(i)),
pts AS (SELECT g.m, (SELECT count(*) FROM tp WHERE tp.m >= g.m) / (SELECT count(*) FROM tp) ret, (SELECT count(*) FROM fp WHERE fp.m < g.m) / (SELECT count(*) FROM fp) rej FROM g)"""


@query("roc_curve", f"WITH {MARGIN_SQL} SELECT m, round(ret, 9) AS retention, round(rej, 9) AS rejection, round(ret + rej - 1, 9) AS j FROM pts")
def roc_curve(t):
    tp, fp = margins(t)
    return rounded(st.roc_youden(tp.where("margin < double('infinity')"), fp, "margin"))


@query("roc_youden", f"""
WITH {MARGIN_SQL}, k AS (SELECT m, round(ret + rej - 1, 12) j FROM pts ORDER BY j DESC, m LIMIT 1)
SELECT m AS knee_m, round(j, 9) AS knee_j, j < 0.5 AS split_advisory, (SELECT count(*) FROM tp) AS n_tp_multi, (SELECT count(*) FROM fp) AS n_fp,
 CASE WHEN j < 0.5 THEN (SELECT round(quantile_cont(m, 0.05), 2) FROM tp) ELSE round(m, 2) END AS min_margin,
 CASE WHEN j < 0.5 THEN (SELECT round(quantile_cont(m, 0.5), 2) FROM tp) END AS low_margin_threshold FROM k""")
def roc_youden(t):
    tp, fp = margins(t)
    return rounded(st.youden_recommendation(tp, fp, "margin"))


@query("identity_separation", """
WITH s AS (SELECT count(*) n, quantile_cont(l_extendedprice / 1000, 0.05) f, quantile_cont(l_quantity, 0.05) c FROM lineitem WHERE l_returnflag = 'A'),
p AS (SELECT quantile_cont(l_extendedprice / 1000, 0.95) c FROM lineitem WHERE l_returnflag <> 'A')
SELECT s.n AS n_same, round(s.f, 6) AS id_floor, round(p.c, 6) AS ceiling, round(s.f - p.c, 6) AS separation_margin, s.f - p.c >= 0.1 AS clean_separation,
 CASE WHEN s.f - p.c >= 0.1 THEN CASE WHEN p.c < round((p.c + s.f) / 2, 1) AND round((p.c + s.f) / 2, 1) < s.f THEN round((p.c + s.f) / 2, 1) ELSE (p.c + s.f) / 2 END ELSE 95 END AS rec_min_id,
 CASE WHEN s.f - p.c >= 0.1 THEN floor(s.c) ELSE 80 END AS rec_min_cov FROM s, p""")
def identity_separation(t):
    rows = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("ident"), F.col("l_quantity").alias("cov"), "l_returnflag")
    return rounded(st.identity_separation(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag <> 'A'"), "ident", "cov"), 6)


@query("role_gap", """
WITH a AS (SELECT c_custkey id, rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 k, count(*) OVER () n FROM customer),
s AS (SELECT o_custkey id, round(sum(o_totalprice), 2) v FROM orders GROUP BY 1),
b AS (SELECT id, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 k, count(*) OVER () n FROM s)
SELECT id, round(b.k / b.n - a.k / a.n, 9) AS gap FROM a JOIN b USING (id)""")
def role_gap(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    b = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return rounded(st.role_gap(a, b, "v"))


@query("stage_saturation", """
WITH r AS (SELECT event_type AS label, event_id, value > 100 bad FROM events), f AS (SELECT label, event_id, row_number() OVER (PARTITION BY label ORDER BY event_id) k FROM r WHERE bad)
SELECT r.label, count(*) AS processed, count(*) FILTER (bad) AS failed, round(count(*) FILTER (bad) / count(*), 9) AS rate, count(*) FILTER (bad) / count(*) >= 0.13 AS saturated,
 coalesce((SELECT string_agg(event_id, ',' ORDER BY event_id) FROM f WHERE f.label = r.label AND k <= 3), '') AS examples FROM r GROUP BY r.label""")
def stage_saturation(t):
    return rounded(st.stage_saturation(t.events, "event_type", F.col("value") > 100, "event_id", 0.13))


@query("rank_agreement", """
WITH d AS (SELECT o_totalprice a, o_totalprice * (CASE WHEN o_orderstatus = 'F' THEN 1.01 ELSE 0.99 END) b FROM orders),
x AS (SELECT round(a - b, 4) d FROM d WHERE round(a - b, 4) <> 0),
k AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 rk, count(*) OVER (PARTITION BY abs(d)) c FROM x),
s AS (SELECT count(*)::DOUBLE n, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) p, sum(CASE WHEN d < 0 THEN rk ELSE 0 END) m, sum(c * c - 1.0) tie FROM k)
SELECT n::BIGINT AS n, least(p, m) AS statistic, round((least(p, m) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie / 48), 6) AS z FROM s""")
def rank_agreement(t):
    b = F.col("o_totalprice") * F.when(F.col("o_orderstatus") == "F", 1.01).otherwise(0.99)
    d = t.orders.select(F.round(F.col("o_totalprice") - b, 4).alias("a"), F.lit(0.0).alias("b"))
    return rounded(st.wilcoxon_signed_rank(d, "a", "b"), 6)


@query("kendall_tau", """
WITH d AS (SELECT c_acctbal a, floor(coalesce(sum(o_totalprice), 0) / 100000) b FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal),
p AS (SELECT sum(sign(x.a - y.a) * sign(x.b - y.b)) s, sum((x.a <> y.a)::INT) na, sum((x.b <> y.b)::INT) nb FROM d x, d y)
SELECT (SELECT count(*) FROM d) AS n, round(s / sqrt(na::DOUBLE * nb), 9) AS tau FROM p""")
def kendall_tau(t):
    d = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey", "c_acctbal").agg(
        F.floor(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)) / 100000).alias("b"))
    return rounded(st.kendall_tau(d, "c_acctbal", "b"))


@query("permutation_null")
def permutation_null(t):
    return rounded(st.permutation_null(votes(t), k=20, n_perm=19))


@query("permuted_votes", f"""
WITH RECURSIVE {RANKS_SQL}, place AS (SELECT id, signal, rk / n r, row_number() OVER (PARTITION BY signal ORDER BY rk, id) - 1 z, count(*) OVER (PARTITION BY signal) m, dense_rank() OVER (ORDER BY signal) - 1 g FROM ranks),
{seats_sql("SELECT i.i * (SELECT max(g) + 1 FROM place) + g p, z, m n FROM place, generate_series(0, 3) i(i)")}
SELECT (p // s)::INTEGER AS scenario, a.id, a.signal AS list, round(b.r, 9) AS r FROM seat CROSS JOIN (SELECT max(g) + 1 s FROM place) JOIN place a ON a.g = p % s AND a.z = seat.z JOIN place b ON b.g = a.g AND b.z = seat.x""")
def permuted_votes(t):
    return rounded(st.permuted_votes(cut(fu.normalized_ranks(votes(t))), 4))


@query("bootstrap_rank_ci")
def bootstrap_rank_ci(t):
    return rounded(st.bootstrap_rank_ci(votes(t), SIGNAL_NAMES, k=50, n_boot=20))


@query("resampled_lists", f"""
WITH {RANKS_SQL}, slots AS (SELECT b.b scenario, s.s slot, ['{"', '".join(SIGNAL_NAMES)}'][floor({uniform_sql("0", "b.b", "s.s")} * {len(SIGNAL_NAMES)})::INT + 1] signal
 FROM generate_series(0, 4) b(b), generate_series(0, {len(SIGNAL_NAMES) - 1}) s(s))
SELECT scenario::INTEGER AS scenario, id, slot::INTEGER AS list, round(rk / n, 9) AS r FROM slots JOIN ranks USING (signal)""")
def resampled_lists(t):
    return rounded(st.resampled_lists(cut(fu.normalized_ranks(votes(t))), SIGNAL_NAMES, 5))


@query("enrichment_null", f"""
WITH RECURSIVE o AS (SELECT c_custkey id, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) place, c_mktsegment = 'BUILDING' hit FROM customer),
z AS (SELECT count(*) FILTER (hit) size, avg(place) FILTER (hit) om, count(*) FILTER (hit AND place <= 100) / 100.0 op FROM o),
{seats_sql("SELECT i.i p, row_number() OVER (PARTITION BY i.i) - 1 z, (SELECT count(*) FROM o) n FROM o, generate_series(0, 29) i(i) WHERE hit")},
d AS (SELECT p sc, avg(x + 1) m, count(*) FILTER (x + 1 <= 100) / 100.0 p FROM seat GROUP BY 1)
SELECT max(size) AS n_positives, round(max(om), 6) AS observed_mean_rank, round((count(*) FILTER (m <= om) + 1) / (count(*) + 1), 9) AS p_value,
 round(max(op), 6) AS precision_at_k, round((count(*) FILTER (p >= op) + 1) / (count(*) + 1), 9) AS precision_p_value FROM d, z""")
def enrichment_null(t):
    o = row_numbers(t.customer.select(F.col("c_custkey").alias("id"), (-F.col("c_acctbal")).alias("o")), [], ["o", "id"], "place")
    pos = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return rounded(st.enrichment_null(o.select("id", "place"), pos, 100, 30), 9).withColumn(
        "observed_mean_rank", F.round("observed_mean_rank", 6)).withColumn("precision_at_k", F.round("precision_at_k", 6))


@query("bootstrap_ci", f"""
WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) s, count(*) OVER () n, (n_chars % 2)::INT - (n_chars % 3 = 0)::INT d FROM documents),
k AS (SELECT i.i sc, floor({uniform_sql("0", "i.i", "s")} * n)::BIGINT + 1 s FROM r, generate_series(0, 49) i(i)),
m AS (SELECT sc, avg(d) m FROM k JOIN r USING (s) GROUP BY 1)
SELECT (SELECT round(avg(d), 9) FROM r) AS observed, round(quantile_cont(m, 0.025), 9) AS ci_lo, round(quantile_cont(m, 0.975), 9) AS ci_hi FROM m""")
def bootstrap_ci(t):
    d = t.documents.select(F.col("doc_id").alias("id"), (F.col("n_chars") % 2).alias("a"), F.when(F.col("n_chars") % 3 == 0, 1).otherwise(0).alias("b"))
    return rounded(st.bootstrap_ci_diff(d, "a", "b", 50))
