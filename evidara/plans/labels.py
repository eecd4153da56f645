"""Votes, labelings and gates over documents, parts and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.operators import labels as lb
from evidara.operators.stats import tasks_for
from evidara.ordering import percentiles
from evidara.plans.registry import query
from evidara.session import cut


def members(t):
    """Documents as group members: source = group, language = family where labelled."""
    return t.documents.join(t.labels, "doc_id", "left").select(
        F.col("source").alias("og"), F.col("doc_id").alias("member"), F.col("doc_id").alias("pos"),
        F.when(F.col("quality").isNotNull(), F.col("lang")).alias("family"),
        F.when(F.col("quality").isNotNull(), F.concat(F.lit("q"), F.col("quality").cast("string"))).alias("subfamily"),
    )


@query("og_vote", """
WITH m AS (SELECT source og, doc_id member, CASE WHEN quality IS NOT NULL THEN lang END family, 'q' || quality subfamily
           FROM documents LEFT JOIN labels USING (doc_id)),
f AS (SELECT og, min(member) fm FROM m GROUP BY 1),
v AS (SELECT m.* FROM m JOIN f USING (og) WHERE member <> fm AND family IS NOT NULL),
fam AS (SELECT og, family, n, sum(n) OVER (PARTITION BY og) tot,
  row_number() OVER (PARTITION BY og ORDER BY n DESC, p) k FROM (SELECT og, family, count(*) n, min(member) p FROM v GROUP BY 1, 2)),
sub AS (SELECT og, family, subfamily, n, sum(n) OVER (PARTITION BY og, family) tot,
  row_number() OVER (PARTITION BY og, family ORDER BY n DESC, p) k
  FROM (SELECT og, family, subfamily, count(*) n, min(member) p FROM v WHERE subfamily IS NOT NULL GROUP BY 1, 2, 3)),
g AS (SELECT og, count(*) n_members FROM m GROUP BY 1),
r AS (SELECT g.og, n_members, coalesce(fam.tot, 0)::BIGINT n_annotated,
  CASE WHEN fam.tot >= 3 THEN fam.n / fam.tot ELSE 0 END share, fam.family, CASE WHEN sub.n / sub.tot >= 0.6 THEN subfamily ELSE '' END s
  FROM g LEFT JOIN fam ON g.og = fam.og AND fam.k = 1 LEFT JOIN sub ON sub.og = fam.og AND sub.family = fam.family AND sub.k = 1)
SELECT m.member, og, CASE WHEN share >= 0.6 THEN r.family ELSE 'unclassified-og' END og_vote_family,
 CASE WHEN share >= 0.6 THEN coalesce(s, '') ELSE '' END og_vote_subfamily, n_members, n_annotated,
 round(share, 9) consensus_fraction FROM m JOIN r USING (og)""")
def og_vote(t):
    m = members(t)
    got = lb.og_vote(m, m.select("member", "pos"), 0.6, 3)
    return got.withColumn("consensus_fraction", F.round("consensus_fraction", 9))


CLASS_SQL = """c AS (SELECT p_brand og, CASE p_type WHEN 'STANDARD' THEN 'A' WHEN 'MEDIUM' THEN 'B' WHEN 'PROMO' THEN 'Z'
  WHEN 'LARGE' THEN 'C' WHEN 'SMALL' THEN 'F' ELSE 'unclassified' END AS class FROM part)"""


def part_classes(t):
    kinds = {"STANDARD": "A", "MEDIUM": "B", "PROMO": "Z", "LARGE": "C", "SMALL": "F"}
    cls = F.lit("unclassified")
    for k, v in kinds.items():
        cls = F.when(F.col("p_type") == k, v).otherwise(cls)
    return t.part.select(F.col("p_brand").alias("og"), cls.alias("class"))


@query("og_class_majority", f"""
WITH {CLASS_SQL}, k AS (SELECT og, class, count(*) n FROM c WHERE class <> 'unclassified' GROUP BY 1, 2),
w AS (SELECT og, class, n / sum(n) OVER (PARTITION BY og) share, row_number() OVER (PARTITION BY og ORDER BY n DESC,
  coalesce(list_position(['A', 'B', 'C', 'F'], class), 5), class) r FROM k)
SELECT o.og, coalesce(w.class, 'unclassified') AS class FROM (SELECT DISTINCT og FROM c) o
LEFT JOIN w ON w.og = o.og AND r = 1 AND share >= 0.22""")
def og_class_majority(t):
    return lb.og_class_majority(part_classes(t), 0.22)


@query("modal_family", """
WITH k AS (SELECT p_brand, p_type, count(*) n FROM part GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY n DESC) rk, sum(n) OVER (PARTITION BY p_brand) tot FROM k)
SELECT p_brand, min(p_type) AS p_type, max(n) AS n_top, max(tot)::BIGINT AS n_total, count(*) AS n_tied FROM r WHERE rk = 1 GROUP BY 1""")
def modal_family(t):
    return lb.modal_label(t.part, ["p_brand"], "p_type")


@query("contingency", "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def contingency(t):
    return lb.contingency(t.documents, "source", "lang")


PRED_SQL = "d AS (SELECT lang truth, CASE WHEN n_chars % 5 = 0 THEN 'de' WHEN n_chars % 3 = 0 THEN 'fr' ELSE 'en' END pred FROM documents)"


def predictions(t):
    pred = F.when(F.col("n_chars") % 5 == 0, "de").when(F.col("n_chars") % 3 == 0, "fr").otherwise("en")
    return t.documents.select(F.col("lang").alias("truth"), pred.alias("pred"))


@query("per_family_metrics", f"""
WITH {PRED_SQL}, t AS (SELECT truth family, count(*) n_total, count(*) FILTER (truth = pred) tp FROM d GROUP BY 1),
p AS (SELECT pred family, count(*) FILTER (truth <> pred) fp, count(*) np FROM d GROUP BY 1)
SELECT family, n_total, tp, n_total - tp AS fn, coalesce(fp, 0) AS fp, round(tp / n_total, 9) AS recall,
 CASE WHEN tp + coalesce(fp, 0) > 0 THEN round(tp / (tp + fp), 9) END AS precision FROM t LEFT JOIN p USING (family)""")
def per_family_metrics(t):
    got = lb.per_family_metrics(predictions(t), "truth", "pred")
    return got.withColumn("recall", F.round("recall", 9)).withColumn("precision", F.round("precision", 9))


@query("adjusted_rand_index", """
WITH c AS (SELECT source a, lang b, count(*) n FROM documents GROUP BY 1, 2),
ra AS (SELECT sum(n * (n - 1) / 2) s FROM (SELECT a, sum(n) n FROM c GROUP BY 1)),
rb AS (SELECT sum(n * (n - 1) / 2) s FROM (SELECT b, sum(n) n FROM c GROUP BY 1)),
ij AS (SELECT sum(n * (n - 1) / 2) s, sum(n) n FROM c)
SELECT round((ij.s - ra.s * rb.s / (ij.n * (ij.n - 1) / 2)) / ((ra.s + rb.s) / 2 - ra.s * rb.s / (ij.n * (ij.n - 1) / 2)), 9) AS ari,
 ij.n::BIGINT AS n FROM ij, ra, rb""")
def adjusted_rand_index(t):
    return lb.adjusted_rand_index(t.documents, "source", "lang").withColumn("ari", F.round("ari", 9))


@query("v_measure", """
WITH c AS (SELECT source a, lang b, count(*) n FROM documents GROUP BY 1, 2), n AS (SELECT sum(n) t FROM c),
ra AS (SELECT a, sum(n) na FROM c GROUP BY 1), rb AS (SELECT b, sum(n) nb FROM c GROUP BY 1),
h AS (SELECT (SELECT -sum(na / t * ln(na / t)) FROM ra, n) ha, (SELECT -sum(nb / t * ln(nb / t)) FROM rb, n) hb,
 -sum(c.n / t * ln(c.n / nb)) ab, -sum(c.n / t * ln(c.n / na)) ba FROM c JOIN ra USING (a) JOIN rb USING (b), n)
SELECT round(1 - ab / ha, 9) AS homogeneity, round(1 - ba / hb, 9) AS completeness,
 round(2 * (1 - ab / ha) * (1 - ba / hb) / ((1 - ab / ha) + (1 - ba / hb)), 9) AS v_measure FROM h""")
def v_measure(t):
    got = lb.v_measure(t.documents, "source", "lang")
    return got.select(*[F.round(c, 9).alias(c) for c in got.columns])


ANCHOR_GROUPS_SQL = """a AS (SELECT l_returnflag AS lvl, o_orderkey acc, min(o_orderpriority) family, min(l_suppkey) og
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2 HAVING min(l_suppkey) = max(l_suppkey))"""


def anchor_groups(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("lvl"), F.col("o_orderkey").alias("acc"),
        F.col("o_orderpriority").alias("family"), F.col("l_suppkey").alias("og"),
    )
    return lb.single_group_anchors(lines, ["lvl", "acc", "family"], "og")


@query("conflation_fragmentation", f"""
WITH {ANCHOR_GROUPS_SQL}, g AS (SELECT lvl, og, count(DISTINCT family) f, count(*) n FROM a GROUP BY 1, 2),
fr AS (SELECT lvl, median(r) med, max(r) mx FROM (SELECT lvl, family, count(DISTINCT og) / count(*) r FROM a GROUP BY 1, 2) GROUP BY 1)
SELECT g.lvl, count(*) AS orthogroups_total, count(*) FILTER (f > 1) AS orthogroups_mixed_family,
 round(count(*) FILTER (f > 1) / count(*), 9) AS frac_orthogroups_mixed, sum(CASE WHEN f > 1 THEN n ELSE 0 END)::BIGINT AS anchors_in_mixed_orthogroup,
 round(sum(CASE WHEN f > 1 THEN n ELSE 0 END) / sum(n), 9) AS frac_anchors_in_mixed, max(f) AS max_families_in_one_orthogroup,
 round(avg(f), 9) AS mean_families_per_orthogroup, round(max(med), 9) AS median_orthogroups_per_anchor, round(max(mx), 9) AS max_orthogroups_per_anchor
FROM g JOIN fr USING (lvl) GROUP BY g.lvl""")
def conflation_fragmentation(t):
    a = cut(anchor_groups(t))
    con = lb.conflation(a, "lvl", "family", "og")
    frag = cut(lb.fragmentation(a, "lvl", "family", "og"))
    med = percentiles(frag, ["lvl"], "orthogroups_per_anchor", {"median_orthogroups_per_anchor": 0.5}).drop("n")
    top = frag.groupBy("lvl").agg(F.max("orthogroups_per_anchor").alias("max_orthogroups_per_anchor"))
    got = con.join(med, "lvl").join(top, "lvl")
    return got.select(*[F.round(c, 9).alias(c) if d == "double" else F.col(c) for c, d in got.dtypes])


PART_ANCHORS_SQL = """p AS (SELECT DISTINCT p_partkey accession, p_brand clade, p_type family, p_size <= 25 characterized, l_suppkey og
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def part_anchors(t):
    # dealt by their number before copies go, so no task holds the keys of more rows than planned
    lines = t.lineitem.select("l_partkey", "l_suppkey")
    lines = lines.repartition(tasks_for(lines.count(), lines), "l_partkey").distinct()
    return lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("accession"), F.col("p_brand").alias("clade"), F.col("p_type").alias("family"),
        (F.col("p_size") <= 25).alias("characterized"), F.col("l_suppkey").alias("og"),
    )


@query("cross_clade_concordance", f"""
WITH {PART_ANCHORS_SQL}, s AS (SELECT og, family md, count(*) n FROM p WHERE clade = 'Brand#1' GROUP BY 1, 2),
q AS (SELECT accession, clade, family, count(*) n_groups FROM p WHERE clade NOT IN ('Brand#1', 'Brand#2') GROUP BY 1, 2, 3),
mt AS (SELECT accession, md, sum(n) n FROM p JOIN s USING (og) WHERE clade NOT IN ('Brand#1', 'Brand#2') GROUP BY 1, 2),
rk AS (SELECT *, rank() OVER (PARTITION BY accession ORDER BY n DESC) r, sum(n) OVER (PARTITION BY accession) tot FROM mt),
b AS (SELECT accession, min(md) md, count(*) tied, max(tot) tot FROM rk WHERE r = 1 GROUP BY 1)
SELECT accession, clade, family, n_groups, coalesce(tot, 0)::BIGINT AS n_reference, coalesce(md, '') AS mode,
 CASE WHEN md IS NULL THEN 'NOT_SPANNED' WHEN tied > 1 THEN 'AMBIGUOUS' WHEN md = family THEN 'AGREE' ELSE 'DISAGREE' END AS bucket
FROM q LEFT JOIN b USING (accession)""")
def cross_clade_concordance(t):
    return lb.cross_clade_concordance(part_anchors(t), "Brand#1", ["Brand#2"])


def _gate_sql(removed: str, held: str) -> str:
    return f"""
WITH {PART_ANCHORS_SQL}, k AS (SELECT *, {held} held FROM p), z AS (SELECT og, count(*) size FROM p GROUP BY 1),
seeds AS (SELECT og, family, count(*) n FROM p WHERE characterized GROUP BY 1, 2),
gone AS ({removed}),
ask AS (SELECT DISTINCT og, held FROM k WHERE clade <> 'Brand#1'),
lft AS (SELECT ask.og, ask.held, s.family, s.n - coalesce(g.gone, 0) n FROM ask JOIN seeds s USING (og)
  LEFT JOIN gone g ON g.og = ask.og AND g.held = ask.held AND g.family = s.family WHERE s.n - coalesce(g.gone, 0) > 0),
rk AS (SELECT *, rank() OVER (PARTITION BY og, held ORDER BY n DESC) r, sum(n) OVER (PARTITION BY og, held) tot,
  count(*) OVER (PARTITION BY og, held) fams FROM lft),
b AS (SELECT og, held, min(family) modal, max(n) n, count(*) tied, max(tot) tot, max(fams) fams FROM rk WHERE r = 1 GROUP BY 1, 2),
v AS (SELECT k.accession, k.clade, k.family, k.og, size, modal, CASE WHEN b.n IS NULL THEN 'no_seed_anchors' WHEN size > 520 THEN 'too_large'
  WHEN tied > 1 THEN 'tied_seed_families' WHEN b.n / tot < 0.8 AND false THEN 'impure_seeds' WHEN b.n < 60 THEN 'too_few_seeds' ELSE '' END why
  FROM k JOIN z USING (og) LEFT JOIN b ON b.og = k.og AND b.held = k.held WHERE clade <> 'Brand#1'),
pick AS (SELECT *, row_number() OVER (PARTITION BY accession ORDER BY (why <> '')::INT, size, og) r FROM v),
o AS (SELECT clade, CASE WHEN why <> '' THEN 'n' WHEN modal = family THEN 'c' ELSE 'w' END oc FROM pick WHERE r = 1)
SELECT coalesce(clade, 'ALL') AS clade, count(*) AS n, count(*) FILTER (oc <> 'n') AS recovered, count(*) FILTER (oc = 'c') AS correct,
 count(*) FILTER (oc = 'w') AS wrong, round(count(*) FILTER (oc <> 'n') / count(*), 9) AS recovery,
 CASE WHEN count(*) FILTER (oc <> 'n') > 0 THEN round(count(*) FILTER (oc = 'c') / count(*) FILTER (oc <> 'n'), 9) ELSE 0 END AS precision
FROM o GROUP BY ROLLUP (clade)"""


def _gate(t, regime):
    a = cut(part_anchors(t))
    sizes = a.groupBy("og").agg(F.count("*").alias("size"))
    rows = lb.gate_loo(a, sizes, regime, 520, 60, "off", skipped_clades=["Brand#1"])
    got = lb.gate_summary(rows)
    return got.withColumn("recovery", F.round("recovery", 9)).withColumn("precision", F.round("precision", 9))


@query("gate_loo", _gate_sql("SELECT og, family held, family, 1 gone FROM seeds", "CASE WHEN characterized THEN family ELSE '' END"))
def gate_loo(t):
    return _gate(t, "leave_one")


@query("gate_leave_clade", _gate_sql("SELECT og, clade held, family, count(*) gone FROM p WHERE characterized GROUP BY 1, 2, 3", "clade"))
def gate_leave_clade(t):
    return _gate(t, "leave_clade")


def three_calls(t):
    d = t.documents
    hmm = t.labels.select(
        F.col("doc_id").alias("id"), F.concat(F.lit("f"), F.col("quality").cast("string")).alias("hmm_family"),
        F.concat(F.lit("s"), F.col("toxic").cast("string")).alias("hmm_subfamily"),
        F.when(F.col("doc_id") % 7 == 0, "fallback").otherwise("tested").alias("threshold_source"))
    og = d.where("lang <> 'de'").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") == "en", "f1").otherwise("unclassified-og").alias("og_vote_family"),
        F.when(F.col("n_chars") % 2 == 0, "s0").otherwise("").alias("og_vote_subfamily"))
    place = d.where("lang <> 'es'").select(
        F.col("doc_id").alias("id"), F.when(F.col("n_chars") % 4 < 3, "f1").otherwise("").alias("placement_family"),
        F.when(F.col("n_chars") % 5 == 0, "s1").otherwise("").alias("placement_subfamily"))
    return hmm, og, place


CALLS_SQL = """
h AS (SELECT doc_id id, 'f' || quality hf, 's' || toxic hs, doc_id % 7 = 0 bad FROM labels),
o AS (SELECT doc_id id, CASE WHEN lang = 'en' THEN 'f1' ELSE 'unclassified-og' END ofm, CASE WHEN n_chars % 2 = 0 THEN 's0' ELSE '' END os FROM documents WHERE lang <> 'de'),
pl AS (SELECT doc_id id, CASE WHEN n_chars % 4 < 3 THEN 'f1' ELSE '' END pf, CASE WHEN n_chars % 5 = 0 THEN 's1' ELSE '' END ps FROM documents WHERE lang <> 'es'),
j AS (SELECT id, coalesce(hf, '') raw, CASE WHEN bad THEN '' ELSE coalesce(hf, '') END hf, coalesce(hs, '') hs, coalesce(bad, false) bad,
  coalesce(ofm, '') o, coalesce(os, '') os, coalesce(pf, '') p, coalesce(ps, '') ps FROM h FULL JOIN o USING (id) FULL JOIN pl USING (id)),
k AS (SELECT *, hf = o AND hf <> '' AS two FROM j),
cons AS (SELECT id, CASE WHEN two AND p = o THEN 'non-chemoreceptor' WHEN two THEN 'likely-non-chemoreceptor' ELSE 'chemoreceptor-candidate' END AS classification,
 CASE WHEN two AND p = o THEN 'high' WHEN two THEN 'medium' ELSE 'NA' END AS classification_confidence,
 CASE WHEN two THEN hf ELSE '' END AS classification_family,
 list_distinct(list_filter([CASE WHEN two THEN hs END, CASE WHEN two THEN os END, CASE WHEN two AND p = hf THEN ps END], lambda x: x IS NOT NULL AND x <> '')) subs,
 'hmm:' || CASE WHEN raw = '' THEN 'NA' WHEN bad THEN raw || '(unvalidated-threshold)' ELSE raw END || ';og:' || CASE WHEN o = '' THEN 'NA' ELSE o END
  || ';placement:' || CASE WHEN p = '' THEN 'NA' ELSE p END AS classification_evidence FROM k)
"""


@query("consensus_three_way", f"""
WITH {CALLS_SQL} SELECT id, classification, classification_confidence, classification_family,
 CASE WHEN len(subs) = 1 THEN subs[1] ELSE '' END AS classification_subfamily, classification_evidence FROM cons""")
def consensus_three_way(t):
    return lb.consensus_three_way(*three_calls(t)).drop("any_call")


@query("evidence_union_priority", """
WITH s AS (SELECT o_custkey id, 0 pr, 'urgent' src, o_orderstatus fam FROM (SELECT o_custkey, min(o_orderstatus) o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
 UNION ALL SELECT c_custkey, 1, 'segment', c_mktsegment FROM customer WHERE c_acctbal > 5000
 UNION ALL SELECT o_custkey, 2, 'big', 'big' FROM orders WHERE o_totalprice > 400000 GROUP BY 1
 UNION ALL SELECT c_custkey, 3, 'all', 'none' FROM customer)
SELECT id, arg_min(fam, pr) AS family, string_agg(src, '+' ORDER BY pr) AS source FROM s GROUP BY 1""")
def evidence_union_priority(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderstatus").alias("family"))
    segment = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("family"))
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("id"), F.lit("big").alias("family"))
    rest = t.customer.select(F.col("c_custkey").alias("id"), F.lit("none").alias("family"))
    return lb.evidence_union({"urgent": urgent, "segment": segment, "big": big, "all": rest}, ["family"])


GATES = ["labelled", "quality", "clean", "length", "language"]


def gated(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    return lb.evidence_funnel(d, {
        "labelled": F.col("quality").isNotNull(), "quality": F.col("quality") == 1, "clean": F.col("toxic") == 0,
        "length": F.col("n_chars") >= 500, "language": F.col("lang").isin("en", "fr"),
    })


@query("evidence_funnel", """
WITH g AS (SELECT quality IS NOT NULL a, coalesce(quality = 1, false) b, coalesce(toxic = 0, false) c, n_chars >= 500 d, lang IN ('en', 'fr') e
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'input' AS stage, count(*) AS survivors FROM g UNION ALL SELECT 'labelled', count(*) FILTER (a) FROM g
UNION ALL SELECT 'quality', count(*) FILTER (a AND b) FROM g UNION ALL SELECT 'clean', count(*) FILTER (a AND b AND c) FROM g
UNION ALL SELECT 'length', count(*) FILTER (a AND b AND c AND d) FROM g UNION ALL SELECT 'language', count(*) FILTER (a AND b AND c AND d AND e) FROM g""")
def evidence_funnel(t):
    return lb.funnel_counts(gated(t), GATES)


@query("paper_burden", """
WITH c AS (SELECT DISTINCT l_orderkey k, l_suppkey paper FROM lineitem), n AS (SELECT paper, count(*) e FROM c GROUP BY 1)
SELECT k AS l_orderkey, min(e) AS min_paper_entry_count FROM c JOIN n USING (paper) GROUP BY 1""")
def paper_burden(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey").cast("string")).alias("papers"))
    return lb.paper_burden(lines, "l_orderkey", F.col("papers"))


@query("clade_family_rollup", """
SELECT p_brand AS clade, p_type AS family, count(*) AS passing, count(*) FILTER (p_size <= 3) AS focused_evidence,
 count(*) FILTER (p_retailprice > 1500) AS functionally_characterized, count(DISTINCT p_name) AS distinct_species FROM part GROUP BY 1, 2""")
def clade_family_rollup(t):
    return lb.clade_family_rollup(t.part, "p_brand", "p_type", F.col("p_size") <= 3, F.col("p_retailprice") > 1500, "p_name")


@query("taxonomic_spread", """
SELECT coalesce(r_name, 'ALL') AS family, count(DISTINCT n_nationkey) AS phyla, count(DISTINCT c_mktsegment) AS classes, count(DISTINCT c_custkey) AS species
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name)""")
def taxonomic_spread(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return lb.taxonomic_spread(rows, "r_name", "n_nationkey", "c_mktsegment", "c_custkey")
