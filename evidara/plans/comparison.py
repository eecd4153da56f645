"""Orders of customers against each other."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.operators import comparison as cp
from evidara.operators import fusion as fu
from evidara.ordering import row_numbers
from evidara.plans.bindings import RANKS_SQL, SIGNAL_NAMES, WEIGHTS
from evidara.plans.fusion import GROUPS, NORM_SQL, SCORE_SQL, normalized, scored, votes
from evidara.plans.registry import query
from evidara.plans.stats import rounded, uniform_sql
from evidara.session import cut


def orders(t):
    """Customers by weighted score, and by fused reciprocal ranks; each list leaves
    out some customers so that ids missing on one side occur."""
    s = scored(t).where("nation <> 3").withColumn("o", -F.col("rank_score"))
    a = row_numbers(s.select("id", "o"), [], ["o", "id"], "place").select("id", "place")
    r = fu.rrf_score(votes(t)).withColumn("o", -F.round("score", 12)).join(
        t.customer.where("c_nationkey <> 5").select(F.col("c_custkey").alias("id")), "id", "left_semi")
    b = row_numbers(r.select("id", "o"), [], ["o", "id"], "place").select("id", "place")
    return cut(a), cut(b)


ORDERS_SQL = RANKS_SQL + "".join(SCORE_SQL.split("wide AS")[1:]).split(")\n", 1)[1] + """
, oa AS (SELECT id, row_number() OVER (ORDER BY rank_score DESC, id) place FROM scored WHERE nation <> 3),
 rr AS (SELECT id, round(sum(1.0 / (60 + rk)), 12) s FROM ranks GROUP BY 1),
 ob AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) place FROM rr JOIN customer ON c_custkey = id WHERE c_nationkey <> 5),
 pl AS (SELECT id, oa.place pa, ob.place pb FROM oa FULL JOIN ob USING (id))
"""


@query("topk_overlap", f"""
WITH {ORDERS_SQL}, k AS (SELECT unnest([20, 50, 200]) k)
SELECT k::INTEGER AS k, count(*) FILTER (pa <= k AND pb <= k) AS n_both, round(count(*) FILTER (pa <= k AND pb <= k) / count(*) FILTER (pa <= k OR pb <= k), 9) AS jaccard,
 round(count(*) FILTER (pa <= k AND pb <= k) / k, 9) AS overlap, count(*) FILTER (pb <= k AND (pa IS NULL OR pa > k)) AS n_entered FROM pl, k GROUP BY k""")
def topk_overlap(t):
    a, b = orders(t)
    return rounded(cp.topk_overlap(cp.both_places(a, b), [20, 50, 200]))


@query("rank_shift", f"""
WITH {ORDERS_SQL}, m AS (SELECT id, coalesce(pa, (SELECT max(pa) FROM pl) + 1) pa, coalesce(pb, (SELECT max(pb) FROM pl) + 1) pb,
 CASE WHEN pa IS NULL OR pa > 100 THEN 'entered' WHEN pb IS NULL OR pb > 100 THEN 'left' ELSE 'stayed' END AS state FROM pl WHERE pa <= 100 OR pb <= 100)
SELECT id, pa, pb, state, abs(pa - pb) AS move FROM m""")
def rank_shift(t):
    a, b = orders(t)
    return cp.topk_movement(cut(cp.both_places(a, b)), 100)


@query("compare_rankings", f"""
WITH {ORDERS_SQL}, c AS (SELECT pa, pb FROM pl WHERE pa IS NOT NULL AND pb IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY pa) ra, rank() OVER (ORDER BY pb) rb FROM c),
tau AS (SELECT sum(sign(x.pa - y.pa) * sign(x.pb - y.pb)) / (count(*) - (SELECT count(*) FROM c)) t FROM c x, c y),
k AS (SELECT unnest([20, 50, 200]) n)
SELECT n::INTEGER AS n, (SELECT count(*) FROM c) AS n_common, (SELECT round(corr(ra, rb), 9) FROM r) AS spearman, (SELECT round(t, 9) FROM tau) AS kendall,
 round(count(*) FILTER (pa <= n AND pb <= n) / count(*) FILTER (pa <= n OR pb <= n), 9) AS jaccard,
 median(abs(pa - coalesce(pb, (SELECT max(pb) FROM pl) + 1))) FILTER (pa <= n) AS median_shift FROM pl, k GROUP BY n""")
def compare_rankings(t):
    a, b = orders(t)
    return rounded(cp.compare_orders(a, b, [20, 50, 200]))


@query("recall_curve", f"""
WITH {ORDERS_SQL}, tr AS (SELECT c_custkey id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000),
h AS (SELECT place FROM oa JOIN tr USING (id)), k AS (SELECT unnest([10, 25, 50, 100, 250, 500, 5000]) n), l AS (SELECT count(*) l FROM oa), tt AS (SELECT count(*) t FROM tr)
SELECT n::INTEGER AS n, round((SELECT count(*) FROM h WHERE place <= n) / t, 9) AS recall, round((SELECT count(*) FROM h WHERE place <= n) / least(n, l), 9) AS precision,
 t AS n_truth_total, (SELECT count(*) FROM h WHERE place <= n) AS n_truth_found, (SELECT round(avg(place), 6) FROM h) AS mean_rank FROM k, l, tt""")
def recall_curve(t):
    a, _ = orders(t)
    truth = t.customer.where("c_mktsegment = 'BUILDING' AND c_acctbal > 5000").select(F.col("c_custkey").alias("id"))
    got = rounded(cp.recall_curve(a, truth, [10, 25, 50, 100, 250, 500, 5000]))
    return got.withColumn("mean_rank", F.round("mean_rank", 6))


DROPS = {"volume": ["orders", "revenue"], "urgent": ["urgent"], "balance": ["balance"]}


def _score_sql(weights, fill=False):
    col = (lambda s: f"coalesce({s}, 0)") if fill else (lambda s: s)
    pres = " + ".join(f"CASE WHEN {col(s)} IS NULL THEN 0 ELSE {w} END" for s, w in weights.items())
    summ = " + ".join(f"coalesce({col(s)} * {w}, 0)" for s, w in weights.items())
    return f"round(({summ}) / ({pres}) * greatest(0.4, ({pres}) / {sum(weights.values())}), 9)"


def _ablation_sql():
    parts = [("", _score_sql(WEIGHTS)), ("missingness", _score_sql(WEIGHTS, True))]
    parts += [(f"group:{n}", _score_sql({s: 0.0 if s in g else w for s, w in WEIGHTS.items()})) for n, g in DROPS.items()]
    union = " UNION ALL ".join(f"SELECT '{n}' AS name, id, {e} sc FROM norm" for n, e in parts)
    return f"""
WITH {NORM_SQL}, u AS ({union}), p AS (SELECT name, id, row_number() OVER (PARTITION BY name ORDER BY sc DESC, id) pb FROM u),
b AS (SELECT id, pb pa FROM p WHERE name = '')
SELECT name, round(corr(pa, pb), 9) AS spearman, round(count(*) FILTER (pa <= 20 AND pb <= 20) / count(*) FILTER (pa <= 20 OR pb <= 20), 9) AS jaccard,
 count(*) FILTER (pb <= 20 AND pa > 20) AS n_moved_in FROM p JOIN b USING (id) WHERE name <> '' GROUP BY name"""


@query("ablation", _ablation_sql())
def ablation(t):
    return rounded(cp.ablation(cut(normalized(t)), WEIGHTS, DROPS, 20))


def _sens_sql(n):
    eff = {s: f"(CASE WHEN it = 0 THEN {w} ELSE {w} * (1 + 0.5 * (2 * {uniform_sql('42', 'it', repr(s))} - 1)) END)" for s, w in WEIGHTS.items()}
    ws = ", ".join(f"{e} w_{s}" for s, e in eff.items())
    pres = " + ".join(f"CASE WHEN {s} IS NULL THEN 0 ELSE w_{s} END" for s in WEIGHTS)
    summ = " + ".join(f"coalesce({s} * w_{s}, 0)" for s in WEIGHTS)
    total = " + ".join(f"w_{s}" for s in WEIGHTS)
    return f"""
WITH {NORM_SQL}, w AS (SELECT it, {ws} FROM generate_series(0, {n}) g(it)),
sc AS (SELECT id, it, round(({summ}) / ({pres}) * greatest(0.4, ({pres}) / ({total})), 9) s FROM norm, w),
r AS (SELECT id, it, rank() OVER (PARTITION BY it ORDER BY s DESC) + (count(*) OVER (PARTITION BY it, s) - 1) / 2.0 k FROM sc)
SELECT id, max(k) FILTER (it = 0) AS baseline_rank, round(avg(k) FILTER (it > 0), 6) AS mean_rank, round(stddev_pop(k) FILTER (it > 0), 6) AS std_rank,
 min(k) FILTER (it > 0) AS min_rank, max(k) FILTER (it > 0) AS max_rank, round(1 - stddev_pop(k) FILTER (it > 0) / (SELECT count(*) FROM norm), 6) AS rank_stability FROM r GROUP BY id"""


@query("weight_sensitivity", _sens_sql(16))
def weight_sensitivity(t):
    return rounded(cp.weight_sensitivity(cut(normalized(t)), WEIGHTS, 16), 6)


@query("select_batch", f"""
WITH {RANKS_SQL}, rr AS (SELECT id, round(sum(1.0 / (60 + rk)), 12) s FROM ranks GROUP BY 1),
o AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) place FROM rr),
l AS (SELECT c_custkey id, c_mktsegment cls, CASE WHEN c_nationkey < 5 THEN '' ELSE 'n' || c_nationkey END cl FROM customer),
e AS (SELECT id, CASE WHEN cl = '' THEN '__alone__' || id ELSE cl END cl, row_number() OVER (ORDER BY place) s0 FROM o JOIN l USING (id) WHERE cls <> 'MACHINERY'),
d AS (SELECT id, CASE WHEN count(*) < 2 THEN 0 ELSE var_pop(rk / n) END v FROM ranks GROUP BY 1),
x AS (SELECT id, cl, (s0 > 1500)::INT t, CASE WHEN s0 <= 1500 THEN -round(v, 12) ELSE 0 END dd, s0 FROM e JOIN d USING (id)),
c AS (SELECT *, row_number() OVER (PARTITION BY cl ORDER BY t, dd, s0) k FROM x),
z AS (SELECT ceil(500 / count(DISTINCT cl)) cap FROM e),
f AS (SELECT id, cl, row_number() OVER (ORDER BY t, dd, s0) seat FROM c, z WHERE k <= cap)
SELECT id, seat::INTEGER AS seat, cl AS cluster FROM f WHERE seat <= 500""")
def select_batch(t):
    r = cut(fu.normalized_ranks(votes(t)))
    s = fu.rrf_score(votes(t)).withColumn("o", -F.round("score", 12))
    order = row_numbers(s.select("id", "o"), [], ["o", "id"], "place").select("id", "place")
    labels = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("classification"),
                               F.when(F.col("c_nationkey") < 5, "").otherwise(F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("cluster"))
    return cp.select_batch(order, r, labels, 500, barred=["MACHINERY"])


VIEW_SQL = SCORE_SQL + """, v AS (SELECT id, segment, nation, rank_score, completeness, row_number() OVER (ORDER BY rank_score DESC, id) final_rank,
  CASE WHEN nation % 4 = 0 THEN 'yes' ELSE 'no' END review, CASE WHEN nation % 6 = 1 THEN 'low' ELSE 'high' END rel, revenue tandem, orders, discount, returned FROM scored)"""


def view_table(t):
    s = scored(t)
    got = fu.final_rank(s)
    return got.select(
        "id", F.col("segment").alias("classification"), "rank_score", "final_rank", F.col("completeness").alias("evidence_completeness"),
        F.when(F.col("nation") % 4 == 0, "yes").otherwise("no").alias("needs_manual_review"),
        F.when(F.col("nation") % 6 == 1, "low").otherwise("high").alias("og_dnds_reliability"),
        F.col("revenue").alias("tandem"), "orders", "discount", "returned")


@query("confidence_view", f"""
WITH {VIEW_SQL} SELECT id, final_rank FROM v WHERE segment = 'BUILDING' AND review <> 'yes' AND completeness >= 0.9""")
def confidence_view(t):
    return cp.confidence_view(view_table(t), "BUILDING", 0.9).select("id", "final_rank")


def _disc_ranks(names):
    return " UNION ALL ".join(
        f"SELECT id, '{s}' signal, rank() OVER (ORDER BY {s} DESC) + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0 rk, count(*) OVER () n FROM mem WHERE {s} IS NOT NULL"
        for s in names)


@query("discovery_view", f"""
WITH {VIEW_SQL}, mem AS (SELECT * FROM v WHERE segment = 'BUILDING' AND (rel = 'low' OR review = 'yes' OR coalesce(tandem, 0) >= 0.5)),
rks AS ({_disc_ranks(['tandem', 'orders', 'discount', 'returned'])}),
sorted AS (SELECT id, rk / n r, row_number() OVER (PARTITION BY id ORDER BY rk / n) k, count(*) OVER (PARTITION BY id) m FROM rks),
fact AS (SELECT i, exp(coalesce(sum(ln(greatest(i, 1))) OVER (ORDER BY i), 0)) f FROM generate_series(0, 20) g(i)),
tails AS (SELECT id, m, k, sum(round(fm.f / (fj.f * fd.f)) * pow(r, j.j) * pow(1 - r, m - j.j)) s
   FROM sorted JOIN generate_series(1, 20) j(j) ON j.j BETWEEN k AND m
   JOIN fact fm ON fm.i = m JOIN fact fj ON fj.i = j.j JOIN fact fd ON fd.i = m - j.j GROUP BY 1, 2, 3)
SELECT id, round(least(min(s), 1.0), 9) AS rho FROM tails GROUP BY 1""")
def discovery_view(t):
    got = cp.discovery_view(view_table(t), ["tandem", "orders", "discount", "returned"], "BUILDING")
    return got.select("id", F.round("rho", 9).alias("rho"))


@query("natural_gap_tiers", f"""
WITH {SCORE_SQL}, s AS (SELECT id, rank_score x, row_number() OVER (ORDER BY rank_score DESC, id) p, lead(rank_score) OVER (ORDER BY rank_score DESC, id) nx FROM scored),
n AS (SELECT greatest(10, floor((count(*) - 1) * 0.6)) m, quantile_cont(x, 0.9) q FROM s), g AS (SELECT nx FROM s, n WHERE p <= m AND nx IS NOT NULL ORDER BY x - nx DESC, p LIMIT 1)
SELECT id, CASE WHEN x >= q THEN 1 WHEN x >= g.nx THEN 2 ELSE 3 END AS tier FROM s, n, g""")
def natural_gap_tiers(t):
    return cp.tiers_by_gap(scored(t).select("id", "rank_score")).select("id", "tier")


@query("consensus_channel", f"""
WITH {RANKS_SQL}, c AS (SELECT id, round(avg(1 - rk / n), 9) emb_novelty FROM ranks GROUP BY 1),
f AS (SELECT id, fam, count(*) k FROM (SELECT id, CASE WHEN rk / n <= 0.33 THEN 'top' WHEN rk / n <= 0.66 THEN 'mid' ELSE 'low' END fam FROM ranks) GROUP BY 1, 2),
w AS (SELECT id, fam, k, row_number() OVER (PARTITION BY id ORDER BY k DESC, fam) r FROM f)
SELECT id, emb_novelty, fam AS emb_nonchemo_family, k AS n_votes, true AS has_emb_data FROM c JOIN w USING (id) WHERE r = 1""")
def consensus_channel(t):
    r = cut(fu.normalized_ranks(votes(t)))
    fam = r.withColumn("emb_nonchemo_family", F.when(F.col("r") <= 0.33, "top").when(F.col("r") <= 0.66, "mid").otherwise("low"))
    nov = r.groupBy("id").agg(F.round(F.avg(1.0 - F.col("r")), 9).alias("emb_novelty"))
    return nov.join(fu.plurality(fam, ["id"], "emb_nonchemo_family"), "id").withColumn("has_emb_data", F.lit(True))


@query("fusion_impact")
def fusion_impact(t):
    v = cut(votes(t))
    a = fu.aggregate_order(v, "rra").select("id", "place")
    b = fu.aggregate_order(v, "rra", GROUPS).select("id", "place")
    p = cut(cp.both_places(a, b))
    top = cp.topk_overlap(p, [20]).select("jaccard").scalar()
    return p.agg(F.round(F.corr("pa", "pb"), 9).alias("order_spearman"), F.max(F.abs(F.col("pa") - F.col("pb"))).alias("max_displacement")).select(
        "*", F.round(top, 9).alias("top_k_jaccard"))


@query("reference_crossval", f"""
WITH {NORM_SQL}, r AS (SELECT c_custkey id, c_nationkey nation, {uniform_sql("7", "c_custkey")} u FROM customer WHERE c_mktsegment = 'BUILDING'),
f AS (SELECT *, floor(u * 5)::INT fold FROM r), c AS (SELECT nation, fold, count(*) k FROM f GROUP BY 1, 2), tot AS (SELECT nation, count(*) k FROM r GROUP BY 1),
s AS (SELECT n.id, g.g fold, round((coalesce(tot.k, 0) - coalesce(c.k, 0)) / 100.0 + coalesce(balance, 0), 9) sc FROM norm n, generate_series(0, 4) g(g)
  LEFT JOIN tot ON tot.nation = n.nation LEFT JOIN c ON c.nation = n.nation AND c.fold = g.g),
k AS (SELECT id, fold, rank() OVER (PARTITION BY fold ORDER BY sc DESC) + (count(*) OVER (PARTITION BY fold, sc) - 1) / 2.0 rk, count(*) OVER (PARTITION BY fold) n FROM s)
SELECT f.fold, f.id, k.rk AS rank, round(100 * (1 - rk / n), 6) AS percentile, 100 * (1 - rk / n) >= 90 AS in_top_10pct FROM f JOIN k ON k.id = f.id AND k.fold = f.fold""")
def reference_crossval(t):
    base = normalized(t).select("id", "nation", F.coalesce("balance", F.lit(0.0)).alias("other"))
    refs = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.lit(0.01).alias("weight"))
    return rounded(cp.reference_crossval(base, refs, "nation", 5, seed=7), 6)
