"""Rank fusion and weighted scores over customer evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.operators import fusion as fu
from evidara.ordering import percentiles
from evidara.plans.bindings import (
    CUSTOMER_SIGNALS, CUSTOMER_WIDE_SQL, RANKS_SQL, SIGNAL_NAMES, VOTES_SQL, WEIGHTS, customer_wide,
)
from evidara.plans.registry import query
from evidara.session import cut

GROUPS = {"orders": "volume", "revenue": "volume"}


def votes(t):
    return fu.build_ranklists(customer_wide(t), CUSTOMER_SIGNALS)


@query("build_ranklists", f"WITH {VOTES_SQL} SELECT id, signal, value FROM votes")
def build_ranklists(t):
    return votes(t)


@query("signal_exclusion", f"""
WITH {VOTES_SQL} SELECT signal, count(*) AS n_voters, round(sum(value), 1) AS total
FROM votes WHERE signal NOT IN ('urgent', 'discount') GROUP BY signal""")
def signal_exclusion(t):
    policy = fu.VotePolicy({**WEIGHTS, "urgent": 0.0, "discount": 0.0})
    got = fu.build_ranklists(customer_wide(t), CUSTOMER_SIGNALS, excluded=policy.excluded())
    return got.groupBy("signal").agg(F.count("*").alias("n_voters"), F.round(F.sum("value"), 1).alias("total"))


@query("normalized_ranks", f"WITH {RANKS_SQL} SELECT id, signal, round(rk / n, 9) AS r FROM ranks")
def normalized_ranks(t):
    return fu.normalized_ranks(votes(t)).select("id", "signal", F.round("r", 9).alias("r"))


FUSED_SQL = RANKS_SQL + """
, fused AS (SELECT id, CASE WHEN signal IN ('orders', 'revenue') THEN 'volume' ELSE signal END AS list, avg(rk / n) r
            FROM ranks GROUP BY 1, 2),
 sorted AS (SELECT id, r, row_number() OVER (PARTITION BY id ORDER BY r) k, count(*) OVER (PARTITION BY id) m FROM fused),
 fact AS (SELECT i, exp(coalesce(sum(ln(greatest(i, 1))) OVER (ORDER BY i), 0)) f FROM generate_series(0, 20) g(i)),
 tails AS (SELECT id, m, k, sum(round(fm.f / (fj.f * fd.f)) * pow(r, j.j) * pow(1 - r, m - j.j)) s
   FROM sorted JOIN generate_series(1, 20) j(j) ON j.j BETWEEN k AND m
   JOIN fact fm ON fm.i = m JOIN fact fj ON fj.i = j.j JOIN fact fd ON fd.i = m - j.j GROUP BY 1, 2, 3),
 rho AS (SELECT id, m::INTEGER m, least(min(s), 1.0) rho FROM tails GROUP BY 1, 2)
"""


@query("rho_statistic", f"WITH {FUSED_SQL} SELECT id, m, round(rho, 9) AS rho FROM rho")
def rho_statistic(t):
    return fu.rho_statistic(votes(t), GROUPS).select("id", "m", F.round("rho", 9).alias("rho"))


_BINOMIAL = "(factorial(({n})::INTEGER) / (factorial(({k})::INTEGER) * factorial((({n}) - ({k}))::INTEGER)))::DOUBLE"
# the places c_k by bisection, then the chance that the last of them to be reached is the k-th
RRA_SQL = FUSED_SQL + f""", known AS (SELECT DISTINCT m, rho FROM rho WHERE rho > 0 AND rho < 1),
 halve(m, rho, k, lo, hi, n) AS (SELECT m, rho, k, 0.0::DOUBLE, 1.0::DOUBLE, 0 FROM known JOIN generate_series(1, 20) k(k) ON k <= m UNION ALL
   SELECT m, rho, k, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END, n + 1 FROM (SELECT *, (lo + hi) / 2 AS mid, list_sum(list_transform(range(k, m + 1),
     lambda j: {_BINOMIAL.format(n="m", k="j")} * pow((lo + hi) / 2, j) * pow(1 - (lo + hi) / 2, m - j))) < rho AS low FROM halve WHERE n < 60)),
 places AS (SELECT m, rho, list(hi ORDER BY k) AS c FROM halve WHERE n = 60 GROUP BY 1, 2),
 clear_(m, rho, c, i, g) AS (SELECT m, rho, c, m, [1.0::DOUBLE] FROM places UNION ALL
   SELECT m, rho, c, i - 1, list_append(g, 1 - list_sum(list_transform(range(i, m + 1), lambda k: {_BINOMIAL.format(n="m - (i - 1)", k="k - (i - 1)")} * pow(c[k], k - (i - 1)) * g[m - k + 1])))
   FROM clear_ WHERE i > 1),
 null_ AS (SELECT m, rho, least(1.0, list_sum(list_transform(range(1, m + 1), lambda k: {_BINOMIAL.format(n="m", k="k")} * pow(c[k], k) * g[m - k + 1]))) AS p FROM clear_ WHERE i = 1),
 rra AS (SELECT id, rho.m, rho.rho, round(CASE WHEN rho.rho <= 0 THEN 0 WHEN rho.rho >= 1 THEN 1 ELSE p END, 9) AS score FROM rho LEFT JOIN null_ USING (m, rho))
"""


@query("rra_score", f"WITH RECURSIVE {RRA_SQL} SELECT id, m, round(rho, 9) AS rho, score FROM rra")
def rra_score(t):
    return fu.rra_score(votes(t), GROUPS).select(
        "id", "m", F.round("rho", 9).alias("rho"), F.round("score", 9).alias("score")
    )


@query("rrf_score", f"WITH {RANKS_SQL} SELECT id, round(sum(1.0 / (60 + rk)), 9) AS score FROM ranks GROUP BY id")
def rrf_score(t):
    return fu.rrf_score(votes(t)).select("id", F.round("score", 9).alias("score"))


@query("aggregate_order", f"""
WITH {RANKS_SQL}, s AS (SELECT id, round(sum(1.0 / (60 + rk)), 12) AS score FROM ranks GROUP BY id)
SELECT id, row_number() OVER (ORDER BY score DESC, id) AS place FROM s""")
def aggregate_order(t):
    got = fu.rrf_score(votes(t)).select("id", F.round("score", 12).alias("score"))
    from evidara.ordering import row_numbers

    return row_numbers(got.withColumn("o", -F.col("score")), [], ["o", "id"], "place").select("id", "place")


@query("tied_block_size", f"WITH RECURSIVE {RRA_SQL} SELECT id, score, count(*) OVER (PARTITION BY score) AS tied_block_size FROM rra")
def tied_block_size(t):
    return fu.tied_block_size(cut(fu.rra_score(votes(t), GROUPS).select("id", F.round("score", 9).alias("score"))))


@query("minmax_normalize", f"""
WITH {CUSTOMER_WIDE_SQL} SELECT id,
 round((revenue_score - min(revenue_score) OVER ()) / (max(revenue_score) OVER () - min(revenue_score) OVER ()), 9) AS revenue_score_norm,
 round((balance_score - min(balance_score) OVER ()) / (max(balance_score) OVER () - min(balance_score) OVER ()), 9) AS balance_score_norm
FROM wide""")
def minmax_normalize(t):
    got = fu.minmax_normalize(cut(customer_wide(t)), ["revenue_score", "balance_score"])
    return got.select("id", F.round("revenue_score_norm", 9).alias("revenue_score_norm"),
                      F.round("balance_score_norm", 9).alias("balance_score_norm"))


NORM_SQL = CUSTOMER_WIDE_SQL + ", norm AS (SELECT id, nation, segment, " + ", ".join(
    f"({s}_score - min({s}_score) OVER ()) / (max({s}_score) OVER () - min({s}_score) OVER ()) AS {s}"
    for s in SIGNAL_NAMES
) + " FROM wide)"
_PRESENT = " + ".join(f"CASE WHEN {s} IS NULL THEN 0 ELSE {w} END" for s, w in WEIGHTS.items())
_SUMMED = " + ".join(f"coalesce({s} * {w}, 0)" for s, w in WEIGHTS.items())
_TOTAL = sum(WEIGHTS.values())
SCORE_SQL = NORM_SQL + f""", scored AS (SELECT *, round(({_SUMMED}) / ({_PRESENT}) * greatest(0.4, ({_PRESENT}) / {_TOTAL}), 9) AS rank_score,
  round(greatest(0.4, ({_PRESENT}) / {_TOTAL}), 9) AS completeness FROM norm)"""


def normalized(t):
    """Customers with every signal scaled to [0, 1]; an unmeasured signal stays null."""
    wide = cut(customer_wide(t))
    got = fu.minmax_normalize(wide, [f"{s}_score" for s in SIGNAL_NAMES], "_n")
    return got.select(
        "id", "nation", "segment",
        *[F.when(F.col(f"{s}_score").isNotNull(), F.col(f"{s}_score_n")).alias(s) for s in SIGNAL_NAMES],
    )


def scored(t):
    got = normalized(t)
    score, share = fu.fair_score({s: F.col(s) for s in SIGNAL_NAMES}, WEIGHTS)
    return got.withColumn("rank_score", F.round(score, 9)).withColumn("completeness", F.round(share, 9))


@query("fair_rank_score", f"WITH {SCORE_SQL} SELECT id, rank_score, completeness FROM scored")
def fair_rank_score(t):
    return scored(t).select("id", "rank_score", "completeness")


@query("confidence_tier", f"""
WITH {SCORE_SQL} SELECT id, CASE WHEN completeness >= 0.6 AND rank_score >= 0.5 THEN 'High'
 WHEN completeness >= 0.4 OR rank_score >= 0.3 THEN 'Medium' ELSE 'Low' END AS tier FROM scored""")
def confidence_tier(t):
    return scored(t).select("id", fu.confidence_tier(F.col("completeness"), F.col("rank_score")).alias("tier"))


@query("evidence_completeness", f"""
WITH {CUSTOMER_WIDE_SQL} SELECT id, round(({' + '.join(f'({s}_score IS NOT NULL)::INT' for s in SIGNAL_NAMES)}) / 6.0, 9) AS completeness
FROM wide""")
def evidence_completeness(t):
    flags = [F.col(f"{s}_score").isNotNull() for s in SIGNAL_NAMES]
    return customer_wide(t).select("id", F.round(fu.evidence_completeness(flags), 9).alias("completeness"))


@query("final_rank", f"""
WITH {SCORE_SQL} SELECT id, rank_score, row_number() OVER (ORDER BY rank_score DESC, id) AS final_rank FROM scored""")
def final_rank(t):
    return fu.final_rank(scored(t).select("id", "rank_score"))


@query("dnds_shrink", f"""
WITH {SCORE_SQL}, med AS (SELECT median(revenue) AS m FROM norm)
SELECT id, round(revenue * least(orders, 1.0) + m * (1 - least(orders, 1.0)), 9) AS shrunk
FROM norm, med WHERE revenue IS NOT NULL""")
def dnds_shrink(t):
    got = cut(normalized(t).where("revenue IS NOT NULL").select("id", "revenue", "orders"))
    neutral = percentiles(got, [], "revenue", {"med": 0.5}).select("med").scalar()
    return got.select("id", F.round(fu.reliability_shrink(got, "revenue", "orders", neutral), 9).alias("shrunk"))


@query("rank_average_consensus", f"""
WITH {RANKS_SQL} SELECT id, round(avg(1 - rk / n), 9) AS consensus FROM ranks GROUP BY id""")
def rank_average_consensus(t):
    return fu.rank_average_consensus(votes(t)).select("id", F.round("consensus", 9).alias("consensus"))


@query("saturation_report", f"""
WITH RECURSIVE {RRA_SQL}, c AS (SELECT score, count(*) c FROM rra GROUP BY 1)
SELECT sum(c)::BIGINT AS n_candidates, sum(CASE WHEN score >= 1 THEN c ELSE 0 END)::BIGINT AS n_saturated,
 round(sum(CASE WHEN score >= 1 THEN c ELSE 0 END) / sum(c), 9) AS fraction_saturated, max(c) AS largest_tie_block,
 sum(CASE WHEN c > 1 THEN c ELSE 0 END)::BIGINT AS n_tied, round(sum(CASE WHEN c > 1 THEN c ELSE 0 END) / sum(c), 9) AS fraction_tied,
 count(*) AS n_distinct_scores FROM c""")
def saturation_report(t):
    rep = fu.saturation_report(votes(t), GROUPS, digits=9)
    return rep.withColumn("fraction_saturated", F.round("fraction_saturated", 9)).withColumn(
        "fraction_tied", F.round("fraction_tied", 9))


# balance has no vote in the production order, so customers without orders stay unscored
TABLE_RRA_SQL = RRA_SQL.replace("WHERE value IS NOT NULL)", "WHERE value IS NOT NULL AND signal <> 'balance')")


@query("candidate_rank_table", f"""
WITH RECURSIVE {TABLE_RRA_SQL}, {NORM_SQL[NORM_SQL.index("norm AS"):]}{SCORE_SQL[len(NORM_SQL):]},
 told AS (SELECT id, score, count(*) OVER (PARTITION BY score) AS ties FROM rra)
SELECT scored.id, segment, rank_score, completeness, told.score AS rra_score, coalesce(ties, 0)::BIGINT AS rra_tied_block_size,
 row_number() OVER (ORDER BY told.score IS NULL, coalesce(told.score, -rank_score), scored.id) AS final_rank,
 CASE WHEN completeness >= 0.6 AND rank_score >= 0.5 THEN 'High'
 WHEN completeness >= 0.4 OR rank_score >= 0.3 THEN 'Medium' ELSE 'Low' END AS confidence_tier,
 ({' + '.join(f'({s} IS NOT NULL)::BIGINT' for s in SIGNAL_NAMES)}) AS n_signals_present FROM scored LEFT JOIN told ON told.id = scored.id""")
def candidate_rank_table(t):
    got = scored(t)
    n = sum((F.col(s).isNotNull().cast("long") for s in SIGNAL_NAMES), F.lit(0).cast("long"))
    got = got.select(
        "id", "segment", "rank_score", "completeness",
        fu.confidence_tier(F.col("completeness"), F.col("rank_score")).alias("confidence_tier"),
        n.alias("n_signals_present"),
    )
    lists = fu.build_ranklists(customer_wide(t), CUSTOMER_SIGNALS, excluded=["balance"])
    scores = cut(fu.rra_score(lists, GROUPS).select("id", F.round("score", 9).alias("score")))
    return fu.fused_rank(got, scores)
