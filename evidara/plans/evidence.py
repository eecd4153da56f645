"""Joins, id work and samples over customers, documents, parts and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.functions import scalars as sc
from evidara.operators import evidence as ev
from evidara.operators import expression as ex
from evidara.operators import labels as lb
from evidara.operators import selection as sl
from evidara.plans.fusion import SCORE_SQL, scored
from evidara.operators.fusion import final_rank
from evidara.plans.labels import CALLS_SQL, three_calls
from evidara.plans.registry import query
from evidara.plans.stats import hash_sql, rounded
from evidara.session import cut



@query("merge_evidence_channels", """
SELECT c_custkey AS id, s.struct_novelty, s.struct_novelty IS NOT NULL AS has_struct_data, e.emb_novelty, e.emb_novelty IS NOT NULL AS has_emb_data, false AS has_or_microswitch_data
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) struct_novelty FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) s ON s.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, max(o_totalprice) emb_novelty FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) e ON e.o_custkey = c_custkey""")
def merge_evidence_channels(t):
    def top(cond, name):
        return t.orders.where(cond).groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias(name))

    base = t.customer.select(F.col("c_custkey").alias("id"))
    chans = {"struct": top("o_orderstatus = 'F'", "struct_novelty"), "emb": top("o_orderpriority = '1-URGENT'", "emb_novelty"), "or_microswitch": None}
    return ev.merge_channels(ev.merge_channels(base, chans), chans)


RANKED_SQL = SCORE_SQL + ", rkd AS (SELECT id, rank_score, row_number() OVER (ORDER BY rank_score DESC, id) final_rank FROM scored)"


def ranked_customers(t):
    return final_rank(scored(t).select("id", "rank_score"))


@query("add_classification", f"""
WITH {RANKED_SQL.strip()}, {CALLS_SQL.strip()}, f AS (SELECT r.id, rank_score, final_rank fr, coalesce(classification, 'chemoreceptor-candidate') cls,
 CASE classification WHEN 'non-chemoreceptor' THEN 0.1 WHEN 'likely-non-chemoreceptor' THEN 0.5 ELSE 1.0 END fac FROM rkd r LEFT JOIN cons c ON c.id = r.id)
SELECT id, cls AS classification, round(rank_score * fac, 10) AS rank_score, row_number() OVER (ORDER BY fac DESC, fr) AS final_rank FROM f""")
def add_classification(t):
    got = ev.add_classification(ranked_customers(t), lb.consensus_three_way(*three_calls(t)))
    return got.select("id", "classification", F.round("rank_score", 10).alias("rank_score"), "final_rank")


@query("add_og_coverage", """
WITH m AS (SELECT source og, count(*) n, count(l.doc_id) k FROM documents LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 1) l USING (doc_id) GROUP BY 1)
SELECT doc_id, n AS og_n_members, k AS og_n_ref_cds, CASE WHEN k >= 10 THEN 'high' WHEN k >= 5 THEN 'medium' ELSE 'low' END AS og_dnds_reliability FROM documents JOIN m ON og = source""")
def add_og_coverage(t):
    d = t.documents.select("doc_id", F.col("source").alias("og"))
    m = t.documents.select(F.col("source").alias("og"), F.col("doc_id").alias("member"))
    return ev.add_og_coverage(d, m, t.labels.where("quality = 1").select(F.col("doc_id").alias("id"))).drop("og")


@query("add_hcr_columns", """
SELECT c_custkey AS id, l.n AS cds_length_bp, p.i AS paralog_min_identity, coalesce(l.n >= 600, false) AND coalesce(p.i <= 0.8, true) AS hcr_probe_friendly FROM customer
LEFT JOIN (SELECT o_custkey, count(*) * 60 n FROM orders GROUP BY 1) l ON l.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, max(o_totalprice) / 600000 i FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) p ON p.o_custkey = c_custkey""")
def add_hcr_columns(t):
    lens = t.orders.groupBy(F.col("o_custkey").alias("id")).agg((F.count("*") * 60).alias("cds_length_bp"))
    par = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("id")).agg((F.max("o_totalprice") / 600000).alias("paralog_min_identity"))
    return ev.add_hcr_columns(t.customer.select(F.col("c_custkey").alias("id")), lens, par)


@query("gene_model_resolve", """
WITH c AS (SELECT l_orderkey protein, min(CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey END) gene, min(l_partkey) parent, bool_or(l_returnflag = 'R') p1 FROM lineitem GROUP BY 1),
m AS (SELECT p_partkey parent, p_size::BIGINT via, p_size = 7 p2 FROM part), j AS (SELECT protein, coalesce(gene, via) gene, p1, p2 FROM c LEFT JOIN m USING (parent)),
g AS (SELECT s_suppkey gene, s_nationkey chrom, s_suppkey * 10 AS start, s_suppkey * 10 + 5 AS "end", s_acctbal < 0 p3 FROM supplier)
SELECT protein, gene, chrom, start, "end", '+' AS strand, NOT (p1 OR coalesce(p2, false) OR p3) AS complete, coalesce(o_totalprice::BIGINT, 0) AS length, 0::BIGINT AS n_tm
FROM j JOIN g USING (gene) LEFT JOIN (SELECT o_orderkey, floor(o_totalprice) o_totalprice FROM orders WHERE o_orderstatus = 'F') o ON o_orderkey = protein""")
def gene_model_resolve(t):
    cds = t.lineitem.select(F.col("l_orderkey").alias("protein"), F.when(F.col("l_linenumber") % 3 == 0, F.col("l_suppkey")).alias("gene"),
                            F.col("l_partkey").alias("parent"), (F.col("l_returnflag") == "R").alias("partial"))
    mrna = t.part.select(F.col("p_partkey").alias("mrna"), F.col("p_size").cast("long").alias("gene"), (F.col("p_size") == 7).alias("partial"))
    genes = t.supplier.select(F.col("s_suppkey").alias("gene"), F.col("s_nationkey").alias("chrom"), (F.col("s_suppkey") * 10).alias("start"),
                              (F.col("s_suppkey") * 10 + 5).alias("end"), F.lit("+").alias("strand"), (F.col("s_acctbal") < 0).alias("partial"))
    lens = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("protein"), F.floor("o_totalprice").alias("length"), F.lit(0).cast("long").alias("n_tm"))
    return ev.resolve_gene_models(cds, mrna, genes, lens)


@query("anti_join_firewall", """
WITH p AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'ref_' || doc_id ELSE doc_id::VARCHAR END id, text FROM documents WHERE source IN ('src0', 'src1')),
r AS (SELECT doc_id::VARCHAR id, text FROM documents WHERE source NOT IN ('src0', 'src1') UNION ALL SELECT doc_id::VARCHAR, text || 'x' FROM documents WHERE source = 'src0' AND doc_id % 3 = 0)
SELECT id, 'shared_id' AS reason FROM p WHERE id IN (SELECT id FROM r) UNION ALL SELECT id, 'reference_prefix' FROM p WHERE id LIKE 'ref\\_%' ESCAPE '\\'
UNION ALL SELECT id, 'identical_sequence' FROM p WHERE text IN (SELECT text FROM r)""")
def anti_join_firewall(t):
    s = F.col("doc_id").cast("string")
    own = F.col("source").isin("src0", "src1")
    p = t.documents.where(own).select(F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("ref_"), s)).otherwise(s).alias("id"), F.col("text").alias("seq"))
    r = t.documents.where(~own).select(s.alias("id"), F.col("text").alias("seq")).unionByName(
        t.documents.where((F.col("source") == "src0") & (F.col("doc_id") % 3 == 0)).select(s.alias("id"), F.concat("text", F.lit("x")).alias("seq")))
    return ev.separation_violations(p, r)


@query("outer_join_integrity", """
WITH a AS (SELECT doc_id, lang, n_chars FROM documents WHERE lang <> 'de'), b AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN 'xx' ELSE lang END lang, n_chars FROM documents WHERE lang <> 'es')
SELECT count(*) FILTER (b.doc_id IS NULL) AS only_left, count(*) FILTER (a.doc_id IS NULL) AS only_right, count(*) FILTER (a.doc_id = b.doc_id) AS n_both,
 count(*) FILTER (a.lang <> b.lang) AS differ_lang, count(*) FILTER (a.n_chars <> b.n_chars) AS differ_n_chars FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def outer_join_integrity(t):
    a = t.documents.where("lang <> 'de'")
    b = t.documents.where("lang <> 'es'").withColumn("lang", F.when(F.col("n_chars") % 7 == 0, "xx").otherwise(F.col("lang")))
    return ev.outer_integrity(a, b, "doc_id", ["lang", "n_chars"])


@query("mapping_gap_audit", """
WITH a AS (SELECT c_custkey id, c_mktsegment clade, n_nationkey, n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey), m AS (SELECT DISTINCT o_custkey id FROM orders WHERE o_totalprice > 450000)
SELECT clade, count(*) AS anchors, count(m.id) AS mapped, count(*) FILTER (m.id IS NULL AND n_regionkey IN (1, 3)) AS identifier_gap, count(*) FILTER (m.id IS NULL AND n_regionkey NOT IN (1, 3)) AS coverage_gap,
 round(count(m.id) / count(*), 9) AS mapped_rate FROM a LEFT JOIN m USING (id) GROUP BY 1""")
def mapping_gap_audit(t):
    a = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("clade"), F.array(F.col("n_regionkey"), F.col("n_nationkey") + 100).alias("lineage"))
    m = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("id"))
    taxa = t.region.where("r_regionkey IN (1, 3)").select(F.col("r_regionkey").alias("taxon"))
    return rounded(ev.mapping_gap_audit(a, m, taxa, "clade"))


@query("identifier_recovery", """
WITH kn AS (SELECT 'D' || doc_id || '.1' id, source || '_' || n_chars nm, lang org, text FROM documents WHERE doc_id % 2 = 0),
ak AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'D' || (doc_id - doc_id % 2) || '.2' ELSE 'X' || doc_id END id, upper(source) || '_' || n_chars nm, lang org, text FROM documents WHERE doc_id % 2 = 1),
r AS (SELECT a.id, a.org, 2 p, 'base_id' tier, k.id m, k.org mo FROM ak a JOIN kn k ON split_part(k.id, '.', 1) = split_part(a.id, '.', 1)
 UNION ALL SELECT a.id, a.org, 3, 'name', k.id, k.org FROM ak a JOIN kn k ON lower(k.nm) = lower(a.nm) UNION ALL SELECT a.id, a.org, 4, 'sequence', k.id, k.org FROM ak a JOIN kn k ON k.text = a.text),
b AS (SELECT id, min(p) p FROM r GROUP BY 1)
SELECT r.id, min(m) AS "match", min(tier) AS tier, count(*) AS n_matches, min(m) <> max(m) AS conflict, arg_min(mo, m) = min(org) AS organism_ok FROM r JOIN b ON b.id = r.id AND b.p = r.p GROUP BY r.id""")
def identifier_recovery(t):
    d = F.col("doc_id")
    kn = t.documents.where("doc_id % 2 = 0").select(F.concat(F.lit("D"), d.cast("string"), F.lit(".1")).alias("id"), F.concat_ws("_", "source", F.col("n_chars").cast("string")).alias("name"),
                                                    F.col("lang").alias("organism"), F.col("text").alias("seq"))
    aid = F.when(d % 3 == 0, F.concat(F.lit("D"), (d - d % 2).cast("string"), F.lit(".2"))).otherwise(F.concat(F.lit("X"), d.cast("string")))
    ak = t.documents.where("doc_id % 2 = 1").select(aid.alias("id"), F.concat_ws("_", F.upper("source"), F.col("n_chars").cast("string")).alias("name"),
                                                    F.col("lang").alias("organism"), F.col("text").alias("seq"))
    return ev.identifier_recovery(ak, kn)


@query("clade_membership_ceiling", """
WITH m AS (SELECT l_suppkey og, l_partkey gene, l_orderkey % 25 organism FROM lineitem), s AS (SELECT DISTINCT og FROM m JOIN part ON p_partkey = gene WHERE p_size = 1),
o AS (SELECT n_nationkey organism, n_regionkey clade, n_name species FROM nation)
SELECT og, count(*) AS n_members, count(DISTINCT species) AS n_species, count(*) FILTER (clade = 0) AS n_0, count(*) FILTER (clade = 1) AS n_1, count(*) FILTER (clade = 2) AS n_2
FROM m JOIN s USING (og) JOIN o USING (organism) GROUP BY 1""")
def clade_membership_ceiling(t):
    m = t.lineitem.select(F.col("l_suppkey").alias("og"), F.col("l_partkey").alias("gene"), (F.col("l_orderkey") % 25).alias("organism"))
    o = t.nation.select(F.col("n_nationkey").alias("organism"), F.col("n_regionkey").alias("clade"), F.col("n_name").alias("species"))
    return ev.clade_ceiling(m, o, t.part.where("p_size = 1").select(F.col("p_partkey").alias("gene")), [0, 1, 2])


@query("taxonomy_lineage_join", """
SELECT c_custkey AS id, CASE WHEN r_name = 'ASIA' THEN 'asia' WHEN c_nationkey = 3 THEN 'three' WHEN r_name = 'EUROPE' THEN 'europe' ELSE 'rest' END AS stratum
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def taxonomy_lineage_join(t):
    lin = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", F.array("r_name", "n_name").alias("lineage"))
    got = t.customer.join(lin, F.col("n_nationkey") == F.col("c_nationkey"))
    return got.select(F.col("c_custkey").alias("id"), ev.lineage_stratum(F.col("lineage"), [("ASIA", "asia"), ("NATION_3", "three"), ("EUROPE", "europe")], "rest").alias("stratum"))


@query("anchor_snapshot", """
WITH a AS (SELECT p_partkey accession, p_type family, CASE WHEN p_size % 3 = 0 THEN 'B' ELSE 'A' END AS class FROM part),
u AS (SELECT l_partkey accession, bool_or(l_returnflag = 'A') ps FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1), h AS (SELECT l_partkey accession, bool_or(l_linestatus = 'F') ps FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
SELECT accession, family, class, u.ps IS NOT NULL AS in_audit, CASE WHEN u.ps IS NOT NULL THEN 'uniprot_audit' WHEN h.ps IS NOT NULL THEN 'orthodb_harvest' ELSE 'none' END AS validation_source,
 coalesce(u.ps, h.ps, false) AS pass_class_a, family <> 'PROMO' AS scoreable_family, coalesce(u.ps, h.ps, false) AND family <> 'PROMO' AS use_primary
FROM a LEFT JOIN u USING (accession) LEFT JOIN h USING (accession) WHERE class = 'A'""")
def anchor_snapshot(t):
    a = t.part.select(F.col("p_partkey").alias("accession"), F.col("p_type").alias("family"), F.when(F.col("p_size") % 3 == 0, "B").otherwise("A").alias("class"))
    u = t.lineitem.where("l_returnflag <> 'N'").groupBy(F.col("l_partkey").alias("accession")).agg(F.max(F.col("l_returnflag") == "A").alias("passes"))
    h = t.lineitem.where("l_returnflag = 'N'").groupBy(F.col("l_partkey").alias("accession")).agg(F.max(F.col("l_linestatus") == "F").alias("passes"))
    return ev.anchor_snapshot(a, u, h, ["promo"])


@query("taxid_fill_and_correct", """
SELECT p_partkey AS accession, 't' || p_size AS taxid, CASE WHEN p_type = 'PROMO' AND p_size > 25 THEN 'LARGE' ELSE p_type END AS family FROM part""")
def taxid_fill_and_correct(t):
    rows = t.part.select(F.col("p_partkey").alias("accession"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("t"), F.col("p_size").cast("string"))).otherwise("").alias("taxid"), F.col("p_type").alias("family"))
    src = t.part.select(F.col("p_partkey").alias("accession"), F.concat(F.lit("t"), F.col("p_size").cast("string")).alias("taxid"))
    fix = t.part.where("p_type = 'PROMO' AND p_size > 25").select(F.col("p_partkey").alias("accession"), F.lit("PROMO").alias("expected"), F.lit("LARGE").alias("new_family"))
    return ev.apply_corrections(ev.apply_corrections(ev.fill_taxids(rows, src), fix), fix)


@query("reference_tier_merge", """
SELECT p_partkey AS accession, p_type AS family, CASE WHEN p_size <= 10 THEN 'base' WHEN p_size <= 20 THEN 'tier5' ELSE 'tier6' END AS tier FROM part WHERE NOT (p_size > 10 AND p_type = 'PROMO')""")
def reference_tier_merge(t):
    p = t.part.select(F.col("p_partkey").alias("accession"), F.col("p_type").alias("family"), "p_size")
    merged, _ = ev.merge_reference_tiers(p.where("p_size <= 10").select("accession", "family", F.lit("base").alias("tier")),
                                         {"tier5": p.where("p_size BETWEEN 5 AND 20").drop("p_size"), "tier6": p.where("p_size >= 21").drop("p_size")},
                                         p.select("accession"), ["PROMO"])
    return merged


@query("inventory_append", """
WITH RECURSIVE e AS (SELECT s_nationkey::BIGINT taxid, 'G' || s_suppkey || '.1' accession FROM supplier),
n AS (SELECT taxid, b, row_number() OVER (ORDER BY pos) r FROM (SELECT c_custkey % 900 taxid, 'G' || (c_custkey * 7 % 800) b, c_custkey pos FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  WHERE taxid NOT IN (SELECT taxid FROM e) AND b NOT IN (SELECT split_part(accession, '.', 1) FROM e)),
g(r, tx, ac) AS (SELECT 0::BIGINT, []::BIGINT[], []::VARCHAR[] UNION ALL
  SELECT n.r, CASE WHEN list_contains(tx, taxid) OR list_contains(ac, b) THEN tx ELSE list_append(tx, taxid) END,
   CASE WHEN list_contains(tx, taxid) OR list_contains(ac, b) THEN ac ELSE list_append(ac, b) END FROM g JOIN n ON n.r = g.r + 1)
SELECT taxid, accession, '' AS source_batch FROM e UNION ALL SELECT unnest(tx), unnest(ac) || '.2', 'b2' FROM (SELECT * FROM g ORDER BY r DESC LIMIT 1)""")
def inventory_append(t):
    e = t.supplier.select(F.col("s_nationkey").cast("long").alias("taxid"), F.concat(F.lit("G"), F.col("s_suppkey").cast("string"), F.lit(".1")).alias("accession"), F.lit("ok").alias("status"))
    n = t.customer.select((F.col("c_custkey") % 900).alias("taxid"), F.concat(F.lit("G"), (F.col("c_custkey") * 7 % 800).cast("string"), F.lit(".2")).alias("accession"),
                          F.col("c_mktsegment").alias("status"), F.col("c_custkey").alias("pos"))
    return ev.inventory_append(e, n, "b2", ["BUILDING", "MACHINERY"]).drop("status")


@query("expression_semi_filter", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')")
def expression_semi_filter(t):
    return ev.restrict_to_ids(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", t.part.where("p_type = 'PROMO'"), "p_partkey")


@query("gprotein_classification", """
WITH h AS (SELECT l_orderkey gene, l_partkey subject, l_extendedprice / 1e6 e, l_returnflag FROM lineitem),
b AS (SELECT gene, p_type c, e, 0 p, 'mollusc_reference' s, subject FROM h JOIN part ON p_partkey = subject WHERE l_returnflag = 'A' AND p_size < 15
 UNION ALL SELECT gene, p_brand, e, 1, 'general_reference', subject FROM h JOIN part ON p_partkey = subject WHERE l_returnflag <> 'A'),
r AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY p, e, subject) k FROM b) SELECT gene, c AS class, e AS evalue, s AS source FROM r WHERE k = 1""")
def gprotein_classification(t):
    h = t.lineitem.select(F.col("l_orderkey").alias("gene"), F.col("l_partkey").alias("subject"), (F.col("l_extendedprice") / 1e6).alias("evalue"), "l_returnflag")
    m = t.part.where("p_size < 15").select(F.col("p_partkey").alias("subject"), F.col("p_type").alias("class"))
    g = t.part.select(F.col("p_partkey").alias("subject"), F.col("p_brand").alias("class"))
    return ev.gprotein_classes(h.where("l_returnflag = 'A'").drop("l_returnflag"), h.where("l_returnflag <> 'A'").drop("l_returnflag"), m, g)


@query("positive_control_lookup", """
WITH c AS (SELECT b.item_id::VARCHAR control, lower(regexp_extract(b.text, '(\\w+ \\w+)', 1)) needle FROM benchmark b),
r AS (SELECT doc_id, lower(text) x FROM documents), h AS (SELECT control, min(doc_id) d FROM c JOIN r ON regexp_matches(x, '(^|\\W)' || needle || '($|\\W)') WHERE needle <> '' GROUP BY 1),
e AS (SELECT control, doc_id d FROM c JOIN r ON control = doc_id::VARCHAR)
SELECT c.control, CASE WHEN e.d IS NOT NULL THEN 'exact_id' WHEN h.d IS NOT NULL THEN 'word_boundary' ELSE 'none' END AS strategy, coalesce(e.d, h.d) AS id FROM c LEFT JOIN h USING (control) LEFT JOIN e USING (control)""")
def positive_control_lookup(t):
    c = t.benchmark.select(F.col("item_id").cast("string").alias("control"), F.array(F.regexp_extract("text", r"(\w+ \w+)", 1)).alias("needles"))
    r = t.documents.select(F.col("doc_id").alias("id"), "text", F.col("doc_id").alias("final_rank"))
    return ev.positive_control_lookup(c, r, ["text"])


@query("truth_verdict", f"""
WITH {CALLS_SQL}, tr AS (SELECT doc_id id, quality = 1 want, 'f' || quality ef, 's' || toxic es FROM labels),
v AS (SELECT tr.*, coalesce(classification IN ('non-chemoreceptor', 'likely-non-chemoreceptor'), false) said, coalesce(classification_family, '') f, CASE WHEN len(subs) = 1 THEN subs[1] ELSE '' END s FROM tr LEFT JOIN cons USING (id))
SELECT id, CASE WHEN NOT want AND NOT said THEN 'TN' WHEN want AND said THEN 'TP' WHEN said THEN 'FP' ELSE 'FN' END AS error_type, want = said AS correct,
 CASE WHEN want AND said THEN ef = f WHEN want OR said THEN false END AS family_correct, CASE WHEN want AND said THEN es = s WHEN want OR said THEN false END AS subfamily_correct FROM v""")
def truth_verdict(t):
    tr = t.labels.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "non-chemoreceptor").otherwise("chemoreceptor").alias("expected_classification"),
                                                  F.concat(F.lit("f"), F.col("quality").cast("string")).alias("expected_family"), F.concat(F.lit("s"), F.col("toxic").cast("string")).alias("expected_subfamily"))
    return ev.truth_verdict(tr, lb.consensus_three_way(*three_calls(t)))


@query("id_code_map", """
WITH c AS (SELECT p_name code, p_brand sp, p_partkey pos FROM part WHERE p_size <> 3), k AS (SELECT code, arg_min(sp, pos) f, min(sp) <> max(sp) a FROM c GROUP BY 1),
u AS (SELECT p_name code, min(p_type) cur FROM part WHERE p_size = 3 GROUP BY 1) SELECT code, coalesce(cur, f) AS species, coalesce(a, false) AS ambiguous FROM k FULL JOIN u USING (code)""")
def id_code_map(t):
    c = t.part.where("p_size <> 3").select(F.col("p_name").alias("code"), F.col("p_brand").alias("species"), F.col("p_partkey").alias("pos"))
    return ev.id_code_map(c, t.part.where("p_size = 3").groupBy(F.col("p_name").alias("code")).agg(F.min("p_type").alias("species")))


@query("subset_by_ids", """
WITH w AS (SELECT DISTINCT l_partkey id FROM lineitem WHERE l_quantity > 48) SELECT id, CASE WHEN p_size <= 20 THEN p_name ELSE p_brand END AS seq FROM w JOIN part ON p_partkey = id WHERE p_size <= 20 OR p_size > 30""")
def subset_by_ids(t):
    w = t.lineitem.where("l_quantity > 48").select(F.col("l_partkey").alias("id"))
    a = t.part.where("p_size <= 20").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("seq"))
    b = t.part.where("p_size <= 15 OR p_size > 30").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("seq"))
    return ev.subset_by_ids(w, [a, b])[0]


@query("missing_from_sources", """
SELECT DISTINCT l_partkey AS id FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity > 48 AND p_size > 20 AND p_size <= 30""")
def missing_from_sources(t):
    w = t.lineitem.where("l_quantity > 48").select(F.col("l_partkey").alias("id"))
    a = t.part.where("p_size <= 20 OR p_size > 30").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("seq"))
    return ev.subset_by_ids(w, [a])[1]


@query("outgroup_draw", "SELECT c_custkey AS id, c_mktsegment AS provenance FROM customer WHERE c_mktsegment <> 'BUILDING' ORDER BY c_acctbal, c_custkey LIMIT 50")
def outgroup_draw(t):
    r = t.customer.select(F.col("c_custkey").alias("id"), F.struct("c_acctbal", "c_custkey").alias("pos"))
    return ev.outgroup_draw(r, t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("provenance")), "BUILDING", 50).select("id", "provenance")


@query("cds_provenance", "SELECT c_custkey AS id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN 'miniprot' ELSE 'native' END AS cds_source FROM customer")
def cds_provenance(t):
    s = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("id"), F.lit("miniprot").alias("cds_source"))
    return ev.cds_provenance(t.customer.select(F.col("c_custkey").alias("id")), s)


@query("class_resolution_verdict", """
SELECT p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN 'UNKNOWN' WHEN p_size % 5 < 3 THEN 'A' ELSE 'B' END AS resolved_class, CASE WHEN p_size % 5 = 0 THEN 'UNRESOLVED' WHEN p_size % 5 < 3 THEN 'KEEP' ELSE 'EVICT' END AS verdict, p_type AS family FROM part""")
def class_resolution_verdict(t):
    ids = t.part.select(F.col("p_partkey").alias("id"))
    rec = t.part.where("p_size % 5 <> 0").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 5 < 3, "A").otherwise("B").alias("resolved_class"))
    return ev.class_resolution_verdict(ids, rec, t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("family")))


@query("ratify_admissions", """
SELECT p_partkey AS accession, p_size % 7 = 6 AS admitted, CASE p_size % 7 WHEN 0 THEN 'not_held' WHEN 1 THEN 'family_mismatch' WHEN 2 THEN 'no_record' WHEN 3 THEN 'wrong_class' WHEN 4 THEN 'taxid_mismatch' WHEN 5 THEN 'no_sequence' ELSE '' END AS reason FROM part""")
def ratify_admissions(t):
    p = t.part.withColumn("accession", F.col("p_partkey")).withColumn("k", F.col("p_size") % 7)
    rules = p.select("accession", F.col("p_type").alias("family"), F.col("p_size").alias("taxid"))
    rec = p.where("k <> 2").select("accession", F.when(F.col("k") == 4, -1).otherwise(F.col("p_size")).alias("taxid"), F.when(F.col("k") == 3, "B").otherwise("A").alias("class"))
    held = p.where("k <> 0").select("accession", F.when(F.col("k") == 1, "other").otherwise(F.col("p_type")).alias("family"))
    return ev.ratify_admissions(rules, rec, held, p.where("k <> 5").select("accession", F.lit(300).alias("length")))


@query("missing_sequences", "SELECT 'O' || o_orderstatus || o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def missing_sequences(t):
    p = t.orders.select(F.concat(F.lit("O"), "o_orderstatus", F.col("o_orderkey").cast("string")).alias("id"))
    c = t.lineitem.where("l_returnflag = 'A'").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(F.concat(F.lit("O"), "o_orderstatus", F.col("o_orderkey").cast("string")).alias("id")).distinct()
    return ev.missing_sequences(p, c, "OF")


@query("conditional_mark", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'old' WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) THEN 'harvested' ELSE '' END AS drop_reason FROM part""")
def conditional_mark(t):
    p = t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, "old").otherwise("").alias("drop_reason"))
    return ev.conditional_mark(p, t.lineitem.where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "drop_reason", "harvested")


@query("join_coverage_guard", """
WITH g AS (SELECT count(*) r, count(l.doc_id) m FROM documents LEFT JOIN labels l USING (doc_id)) SELECT r AS requested, m AS matched, round(m / r, 9) AS share, CASE WHEN m = 0 THEN 'error' WHEN m / r < 0.5 THEN 'warning' ELSE 'ok' END AS state FROM g""")
def join_coverage_guard(t):
    return rounded(ev.coverage_guard(t.documents, t.labels, "doc_id"))


@query("sequence_dedup", """
WITH g AS (SELECT doc_id, text, n_chars >= 300 a, lang = 'en' b, text IN (SELECT text FROM documents WHERE source = 'src3') p FROM documents)
SELECT 'input' AS step, count(*) AS n FROM g UNION ALL SELECT 'long', count(*) FILTER (a) FROM g UNION ALL SELECT 'english', count(*) FILTER (a AND b) FROM g
UNION ALL SELECT 'not_probe', count(*) FILTER (a AND b AND NOT p) FROM g UNION ALL SELECT 'distinct_sequence', count(DISTINCT CASE WHEN a AND b AND NOT p THEN text END) FROM g""")
def sequence_dedup(t):
    d = t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("seq"), "n_chars", "lang")
    gates = [("long", F.col("n_chars") >= 300), ("english", F.col("lang") == "en")]
    return ev.sequence_dedup(d, gates, t.documents.where("source = 'src3'").select(F.col("text").alias("seq")))[1]


@query("sequence_dedup_kept", """
SELECT min(doc_id) AS id FROM documents WHERE n_chars >= 300 AND lang = 'en' AND text NOT IN (SELECT text FROM documents WHERE source = 'src3') GROUP BY text""")
def sequence_dedup_kept(t):
    d = t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("seq"), "n_chars", "lang")
    gates = [("long", F.col("n_chars") >= 300), ("english", F.col("lang") == "en")]
    return ev.sequence_dedup(d, gates, t.documents.where("source = 'src3'").select(F.col("text").alias("seq")))[0].select("id")


@query("id_assignment", """
WITH e AS (SELECT c_custkey id, c_nationkey taxid, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) * 2 nr FROM customer WHERE c_mktsegment = 'BUILDING'),
h AS (SELECT taxid, max(nr) h FROM e GROUP BY 1), f AS (SELECT c_custkey id, c_nationkey taxid, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) k FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT id, 'ref_' || taxid || '_' || nr AS short_id, false AS is_new FROM e UNION ALL SELECT id, 'ref_' || taxid || '_' || (coalesce(h, 0) + k), true FROM f LEFT JOIN h USING (taxid)""")
def id_assignment(t):
    from evidara.ordering import row_numbers

    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("taxid"), F.col("c_acctbal").alias("pos"), "c_mktsegment")
    e = row_numbers(c.where("c_mktsegment = 'BUILDING'"), ["taxid"], ["id"], "k").select("id", "taxid", (F.col("k") * 2).alias("number"))
    return ev.id_assignment(c.select("id", "taxid", "pos"), e)


@query("best_hit", """
WITH h AS (SELECT l_orderkey q, l_suppkey t, l_quantity s FROM lineitem), b AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, t) k FROM h),
x AS (SELECT q, t, s FROM b WHERE k = 1), n AS (SELECT h.q, max(h.s) s2 FROM h JOIN x ON x.q = h.q AND x.t <> h.t GROUP BY 1)
SELECT x.q AS query, t AS target, x.s AS score, coalesce(x.s - s2 < 3, false) AS ambiguous FROM x LEFT JOIN n USING (q)""")
def best_hit(t):
    h = t.lineitem.select(F.col("l_orderkey").alias("query"), F.col("l_suppkey").alias("target"), F.col("l_quantity").alias("score"))
    return ev.best_hit(h, "query", "score", 3, ["target"])


@query("best_assembly", """
WITH a AS (SELECT l_orderkey taxid, l_partkey * 10 + l_linenumber accession, CASE WHEN l_returnflag = 'A' THEN 20 WHEN l_returnflag = 'N' THEN 10 ELSE 0 END + (l_linestatus = 'F')::INT r, 4 - l_suppkey % 4 lv, l_shipdate::DATE::VARCHAR d FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY taxid ORDER BY r DESC, lv DESC, d DESC, accession DESC) n FROM a WHERE r % 2 = 1) SELECT taxid, accession FROM k WHERE n = 1""")
def best_assembly(t):
    k = F.col("l_suppkey") % 4
    a = t.lineitem.select(
        F.col("l_orderkey").alias("taxid"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("accession"),
        F.when(F.col("l_returnflag") == "A", "RefSeq").when(F.col("l_returnflag") == "N", "GenBank").otherwise("other").alias("source"),
        (F.col("l_linestatus") == "F").alias("annotated"),
        F.when(k == 0, "Complete Genome").when(k == 1, "Chromosome").when(k == 2, "Scaffold").otherwise("Contig").alias("level"), F.col("l_shipdate").cast("date").cast("string").alias("date"))
    return ev.best_assembly(a).select("taxid", "accession")


@query("first_wins_dedup", "SELECT text_hash AS h, min(doc_id) AS doc_id, count(*) AS n_rows FROM (SELECT md5(text) text_hash, doc_id FROM documents) GROUP BY 1")
def first_wins_dedup(t):
    return lb.first_per_key(t.documents.select(F.md5("text").alias("h"), "doc_id"), ["h"], [F.col("doc_id")])


@query("distinct_union_ids", "SELECT o_custkey AS id FROM orders WHERE o_totalprice > 400000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def distinct_union_ids(t):
    return ev.union_ids([t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("id")), t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))])


@query("set_diff_sites", """
WITH a AS (SELECT DISTINCT l_partkey k FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_partkey k FROM lineitem WHERE l_returnflag <> 'A')
SELECT k AS site, 'high_confidence' AS tier FROM a WHERE k IN (SELECT k FROM b) UNION ALL SELECT k, 'strict_only' FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'lenient_only' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def set_diff_sites(t):
    sites = t.lineitem.select(F.col("l_partkey").alias("site"), "l_returnflag")
    return ev.site_tiers(sites.where("l_returnflag = 'A'"), sites.where("l_returnflag <> 'A'"), "site")


@query("manifest_merge", """
SELECT s_suppkey AS taxid, s_name AS binomial, NULL::VARCHAR AS source FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def manifest_merge(t):
    a = t.supplier.select(F.col("s_suppkey").alias("taxid"), F.col("s_name").alias("binomial"))
    b = t.customer.select(F.col("c_custkey").alias("taxid"), F.col("c_name").alias("binomial"), F.col("c_mktsegment").alias("source"))
    return ev.merge_manifests(a, b, "taxid")


@query("anchor_set_build", """
WITH s AS (SELECT p_partkey a, p_type sub, p_brand org, 0 tier FROM part WHERE p_size < 10 UNION ALL SELECT p_partkey, p_type, p_brand, 1 FROM part WHERE p_size >= 5),
o AS (SELECT a, min(tier) tier, min(sub) sub, min(org) org FROM s GROUP BY 1), t AS (SELECT *, row_number() OVER (PARTITION BY sub, org ORDER BY tier, a) tn FROM o),
k AS (SELECT *, row_number() OVER (PARTITION BY sub ORDER BY tn, org, a) st FROM t) SELECT a AS accession, tier, sub AS subfamily, org AS organism FROM k WHERE st <= 40""")
def anchor_set_build(t):
    p = t.part.select(F.col("p_partkey").alias("accession"), F.col("p_type").alias("subfamily"), F.col("p_brand").alias("organism"), "p_size")
    return sl.anchor_set([p.where("p_size < 10"), p.where("p_size >= 5")], 40)


@query("quota_subsample", """
WITH c AS (SELECT source, lang, count(*) n, CASE lang WHEN 'en' THEN 1.0::DOUBLE WHEN 'fr' THEN 2.0 WHEN 'es' THEN 3.0 WHEN 'de' THEN 0.5 ELSE 1.0 END w FROM documents GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER () tot, greatest(1, floor(n * w / sum(n * w) OVER () * 300))::BIGINT b FROM c),
g AS (SELECT *, 300 - sum(b) OVER () gap, coalesce(sum(b - 1) OVER (ORDER BY w, source, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) low,
  coalesce(sum(greatest(0, n - b)) OVER (ORDER BY -w, source, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) high FROM t),
q AS (SELECT source, lang, CASE WHEN tot <= 300 THEN n WHEN gap < 0 THEN b - least(b - 1, greatest(0, -gap - low)) ELSE b + least(greatest(0, n - b), greatest(0, gap - high)) END quota FROM g)
SELECT doc_id, source, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) k FROM documents) JOIN q USING (source, lang) WHERE k <= quota""")
def quota_subsample(t):
    return sl.quota_subsample(t.documents.select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], {"en": 1.0, "fr": 2.0, "es": 3.0, "de": 0.5}, "lang",
                              [-F.col("n_chars"), F.col("doc_id")], 300)


@query("backbone_selection", """
WITH p AS (SELECT p_brand family, p_type sub, p_name sp, p_partkey a, p_name LIKE 'red%' inv FROM part), l AS (SELECT family, arg_min(a, (sp, a)) ld FROM p WHERE inv GROUP BY 1),
t AS (SELECT p.*, CASE WHEN a = ld THEN 0 ELSE row_number() OVER (PARTITION BY p.family, sub, coalesce(a = ld, false) ORDER BY inv, a) END tn FROM p LEFT JOIN l ON l.family = p.family),
k AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY tn, sub, a) st FROM t) SELECT family, sub AS subfamily, a AS accession FROM k WHERE st <= 9""")
def backbone_selection(t):
    p = t.part.select(F.col("p_brand").alias("family"), F.col("p_type").alias("subfamily"), F.col("p_name").alias("species"), F.col("p_partkey").alias("accession"))
    return sl.backbone_selection(p, 9, F.col("species").startswith("red")).select("family", "subfamily", "accession")


@query("balanced_sample", f"""
WITH c AS (SELECT c_nationkey s, least(40, count(*)) top FROM customer GROUP BY 1),
a AS (SELECT s, top, CASE WHEN s IN (3, 7) THEN top ELSE least(5, top) END a, CASE s WHEN 1 THEN 3.0::DOUBLE WHEN 2 THEN 2.0 ELSE 1.0 END w FROM c),
slot AS (SELECT s, j, sum(-ln(1 - (('0x' || substr({hash_sql("1", "s", "j")}, 1, 8))::BIGINT / 4294967296.0::DOUBLE)) / w) OVER (PARTITION BY s ORDER BY j) due
  FROM (SELECT s, w, unnest(range(1, top - a + 1)) j FROM a)),
won AS (SELECT s, count(*) more FROM (SELECT s, row_number() OVER (ORDER BY due, s, j) k FROM slot) WHERE k <= 400 - (SELECT sum(a) FROM a) GROUP BY 1),
take AS (SELECT a.s, a + coalesce(more, 0) n FROM a LEFT JOIN won USING (s))
SELECT id, species FROM (SELECT c_custkey id, c_nationkey species, row_number() OVER (PARTITION BY c_nationkey ORDER BY {hash_sql("1", "c_custkey")}, c_custkey) k FROM customer)
JOIN take ON take.s = species WHERE k <= n""")
def balanced_sample(t):
    return sl.balanced_sample(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("species")), "species", "id", 400, 5, 40, [3, 7], {1: 3.0, 2: 2.0}, seed=1)


@query("stratified_frame", f"""
WITH f AS (SELECT o_custkey k, arg_min(o_orderpriority, (-o_totalprice, o_orderkey)) pr FROM orders WHERE o_totalprice > 20000 GROUP BY 1),
s AS (SELECT *, row_number() OVER (ORDER BY {hash_sql("5", "k")}, k) r FROM f) SELECT pr AS o_orderpriority, count(*) AS in_frame, count(*) FILTER (r <= 200) AS in_sample FROM s GROUP BY 1""")
def stratified_frame(t):
    o = t.orders.select("o_custkey", "o_orderpriority", "o_totalprice", "o_orderkey")
    return sl.stratified_frame(o, "o_custkey", [-F.col("o_totalprice"), F.col("o_orderkey")], F.col("o_totalprice") > 20000, "o_orderpriority", 200, 5)[1]


@query("shard_assign", "SELECT doc_id, ((row_number() OVER (ORDER BY source, doc_id) - 1) % 7)::INTEGER AS shard FROM documents")
def shard_assign(t):
    return sl.shard_assign(t.documents.select("doc_id", "source"), ["source", "doc_id"], 7).select("doc_id", "shard")


@query("greedy_spread_harvest")
def greedy_spread_harvest(t):
    size = F.col("p_size")
    p = t.part.select(F.col("p_type").alias("family"), F.col("p_partkey").alias("id"), F.concat(F.lit("y"), size % 3).alias("phylum"),
                      F.concat(F.lit("c"), size % 10).alias("class"), F.when(size > 1, F.concat(F.lit("o"), size)).alias("order"))
    held = p.where(F.col("id") % 50 == 0).select("family", F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("name")) for r in sl.RANKS])).alias("h")).select("family", "h.*")
    return sl.greedy_spread(p, "family", held.where("name IS NOT NULL"), 3)


# ---- expression and family tables ---------------------------------------------------

EXPR_SQL = "q AS (SELECT l_partkey gene, l_returnflag || l_linestatus tissue, l_quantity tpm FROM lineitem), em AS (SELECT gene, tissue, avg(tpm) tpm FROM q GROUP BY 1, 2)"


def quant(t):
    return t.lineitem.select(F.col("l_partkey").alias("gene"), F.concat("l_returnflag", "l_linestatus").alias("tissue"), F.col("l_quantity").alias("tpm"))


def means(t):
    return ex.replicate_mean(quant(t), ["gene", "tissue"])


@query("replicate_mean", f"WITH {EXPR_SQL} SELECT gene, tissue, round(tpm, 9) AS tpm FROM em")
def replicate_mean(t):
    return rounded(means(t))


TISSUES = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query("expression_pivot", f"WITH {EXPR_SQL} SELECT gene, " + ", ".join(f"round(max(tpm) FILTER (tissue = '{x}'), 9) AS {x}" for x in TISSUES) + " FROM em GROUP BY 1")
def expression_pivot(t):
    return rounded(ex.expression_pivot(quant(t), TISSUES))


@query("tau_index", f"WITH {EXPR_SQL} SELECT gene, CASE WHEN count(*) >= 2 THEN round((count(*) - sum(tpm) / max(tpm)) / (count(*) - 1), 9) END AS tau FROM em GROUP BY 1")
def tau_index(t):
    return rounded(ex.tau_index(means(t)))


@query("tissue_enrichment", f"""
WITH {EXPR_SQL}, s AS (SELECT gene, avg(tpm) FILTER (tissue LIKE 'A%') a, avg(tpm) FILTER (tissue NOT LIKE 'A%') b, (count(*) - sum(tpm) / max(tpm)) / (count(*) - 1) tau, count(*) n,
 arg_max(tissue, (tpm, tissue LIKE 'A%', tissue)) top FROM em GROUP BY 1)
SELECT gene, round(coalesce(a, 0), 9) AS mean_in, round(CASE WHEN a IS NULL THEN 0 WHEN b IS NULL THEN a ELSE (a + 0.1) / (b + 0.1) END, 9) AS enrichment, CASE WHEN n >= 2 THEN round(tau, 9) END AS tau, top AS top_tissue,
 coalesce(n >= 2 AND tau >= 0.2 AND top LIKE 'A%', false) AS specific FROM s""")
def tissue_enrichment(t):
    return rounded(ex.tissue_enrichment(means(t), F.col("tissue").startswith("A"), 0.2))


@query("expression_stats", """
WITH q AS (SELECT l_partkey gene, l_orderkey * 10 + l_linenumber sample, l_quantity tpm, l_returnflag = 'A' i FROM lineitem)
SELECT gene, round(avg(tpm), 9) AS mean_tpm, max(tpm) AS max_tpm, round(median(tpm), 9) AS median_tpm, round(stddev_samp(tpm), 9) AS std_tpm, round(stddev_samp(tpm) / avg(tpm), 9) AS cv, count(*) FILTER (tpm >= 10) AS n_expressed,
 round(count(*) FILTER (tpm >= 10) / count(*) * 100, 9) AS pct_expressed, arg_min(sample, (-tpm, sample)) AS top_sample, round(avg(tpm) FILTER (i) / avg(tpm) FILTER (NOT i), 9) AS fold_change,
 coalesce(avg(tpm) FILTER (i) / avg(tpm) FILTER (NOT i) > 2, false) AS enriched FROM q GROUP BY 1""")
def expression_stats(t):
    q = t.lineitem.select(F.col("l_partkey").alias("gene"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sample"), F.col("l_quantity").alias("tpm"), "l_returnflag")
    return rounded(ex.expression_stats(q, 10, F.col("l_returnflag") == "A"))


@query("coexpression", """
WITH e AS (SELECT l_partkey gene, l_suppkey % 20 species, l_returnflag tissue, avg(l_quantity) tpm FROM lineitem GROUP BY 1, 2, 3), o AS (SELECT * FROM e WHERE tpm >= 20 AND tissue IN ('A', 'N')),
p AS (SELECT species, tissue, min(gene) partner FROM o JOIN part ON p_partkey = gene WHERE p_type IN ('PROMO', 'SMALL') AND p_size < 10 GROUP BY 1, 2),
j AS (SELECT gene, partner, tissue, CASE tissue WHEN 'A' THEN 1.0 ELSE 0.75 END s FROM o JOIN p USING (species, tissue)), r AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY s DESC, partner, tissue) k FROM j)
SELECT gene, partner, p_type AS partner_class, tissue, s::DOUBLE AS score FROM r JOIN part ON p_partkey = partner WHERE k = 1""")
def coexpression(t):
    e = t.lineitem.groupBy(F.col("l_partkey").alias("gene"), (F.col("l_suppkey") % 20).alias("species"), F.col("l_returnflag").alias("tissue")).agg(F.avg("l_quantity").alias("tpm"))
    p = t.part.where("p_size < 10").select(F.col("p_partkey").alias("gene"), F.col("p_type").alias("class"), F.col("p_partkey").alias("pos"))
    return ex.coexpression(e, p, {"A": 1.0, "N": 0.75}, ["PROMO", "SMALL"], 20)


@query("family_count_matrix", """
WITH m AS (SELECT l_partkey og, l_returnflag sp FROM lineitem) SELECT og, count(*) FILTER (sp = 'A') AS A, count(*) FILTER (sp = 'N') AS N, count(*) FILTER (sp = 'R') AS R FROM m GROUP BY 1 HAVING count(*) <= 32""")
def family_count_matrix(t):
    return ex.family_count_matrix(t.lineitem.select(F.col("l_partkey").alias("og"), F.col("l_returnflag").alias("species")), ["A", "N", "R"], 32)


FAMB_SQL = """fam AS (SELECT o_orderkey og, o_totalprice / 600000 family_p FROM orders), br AS (SELECT l_orderkey og, 'b' || l_suppkey branch, (l_quantity - 20)::BIGINT change,
 CASE WHEN l_tax > 0.02 THEN l_discount END branch_p, l_partkey * 10 + l_linenumber pos FROM lineitem)"""


def families(t):
    fam = t.orders.select(F.col("o_orderkey").alias("og"), (F.col("o_totalprice") / 600000).alias("family_p"))
    br = t.lineitem.select(F.col("l_orderkey").alias("og"), F.concat(F.lit("b"), F.col("l_suppkey").cast("string")).alias("branch"), (F.col("l_quantity") - 20).cast("long").alias("change"),
                           F.when(F.col("l_tax") > 0.02, F.col("l_discount")).alias("branch_p"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return fam, br


@query("significant_families", f"WITH {FAMB_SQL} SELECT og, round(family_p, 9) AS family_p, branch, change, branch_p FROM fam LEFT JOIN br USING (og) WHERE family_p < 0.05")
def significant_families(t):
    fam, br = families(t)
    return rounded(ex.significant_families(fam, br.drop("pos"), 0.05))


@query("family_expansion", f"""
WITH {FAMB_SQL}, j AS (SELECT br.*, coalesce(branch_p, family_p) p FROM br JOIN fam USING (og) WHERE family_p < 0.3), s AS (SELECT og, sum(change) FILTER (change > 0) tot, count(*) FILTER (change > 0) n, sum(CASE WHEN branch LIKE '%b1%' THEN change ELSE 0 END) cp FROM j GROUP BY 1),
b AS (SELECT *, row_number() OVER (PARTITION BY og ORDER BY p, change DESC, pos) k FROM j WHERE change > 0)
SELECT og, round(p, 9) AS expansion_pvalue, branch AS expansion_branch, cp::BIGINT AS focal_copies, greatest(1, tot - change)::BIGINT AS ancestral_copies, round((greatest(1, tot - change) + change) / greatest(1, tot - change), 9) AS expansion_fold, n AS total_expansion_events
FROM b JOIN s USING (og) WHERE k = 1""")
def family_expansion(t):
    fam, br = families(t)
    return rounded(ex.family_expansion(fam, br, 0.3, "b1"))


CLUS_SQL = "cl AS (SELECT md5(text) cluster, doc_id member, doc_id = min(doc_id) OVER (PARTITION BY md5(text)) is_rep FROM documents)"


def clusters(t):
    d = t.documents.select(F.md5("text").alias("cluster"), F.col("doc_id").alias("member"))
    first = d.groupBy("cluster").agg(F.min("member").alias("f"))
    return d.join(first, "cluster").select("cluster", "member", F.lit(100.0).alias("identity"), (F.col("member") == F.col("f")).alias("is_rep"))


@query("cluster_mapping", f"WITH {CLUS_SQL} SELECT cluster, member, 100.0::DOUBLE AS identity, min(member) OVER (PARTITION BY cluster) AS representative, count(*) OVER (PARTITION BY cluster) AS size FROM cl")
def cluster_mapping(t):
    return ex.cluster_mapping(clusters(t))


@query("cluster_summary", f"""
WITH {CLUS_SQL}, s AS (SELECT cluster, count(*) n FROM cl GROUP BY 1) SELECT sum(n)::BIGINT AS n_sequences, count(*) AS n_clusters, round(1 - count(*) / sum(n), 9) AS reduction, count(*) FILTER (n = 1) AS n_singletons, max(n) AS max_size, round(avg(n), 9) AS mean_size FROM s""")
def cluster_summary(t):
    return rounded(ex.cluster_summary(clusters(t)))


@query("distinct_taxa", "SELECT c_nationkey AS taxid, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def distinct_taxa(t):
    m = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("taxid"), F.when(F.col("c_mktsegment") == "BUILDING", "reference").otherwise("txome").alias("source_type"))
    return ex.distinct_taxa(t.orders.select(F.col("o_custkey").alias("id")), m, True)


@query("anchor_block_summary", """
WITH z AS (SELECT l_orderkey b, count(*) n FROM lineitem GROUP BY 1), o AS (SELECT DISTINCT l_partkey g, l_orderkey b FROM lineitem) SELECT g AS gene, count(*) AS n_blocks, sum(n)::BIGINT AS n_anchors FROM o JOIN z USING (b) GROUP BY 1""")
def anchor_block_summary(t):
    return ex.anchor_block_summary(t.lineitem.select(F.col("l_orderkey").alias("block"), F.col("l_partkey").alias("gene_a")), "gene_a")


@query("site_summary", """
WITH s AS (SELECT l_partkey og, CASE WHEN l_tax > 0.01 THEN l_discount END p, CASE WHEN l_linenumber < 6 THEN l_quantity / 10 END b FROM lineitem)
SELECT og, count(*) AS n_sites_total, count(*) FILTER (p < 0.05 AND b > 1) AS n_sites_episodic, round(count(*) FILTER (p < 0.05 AND b > 1) / count(*), 6) AS fraction_episodic, round(avg(b) FILTER (p < 0.05 AND b > 1), 9) AS mean_beta_plus, round(median(p), 9) AS median_p_value FROM s GROUP BY 1""")
def site_summary(t):
    nan = F.lit(float("nan"))
    s = t.lineitem.select(F.col("l_partkey").alias("og"), F.when(F.col("l_tax") > 0.01, F.col("l_discount")).otherwise(nan).alias("p_value"), F.when(F.col("l_linenumber") < 6, F.col("l_quantity") / 10).otherwise(nan).alias("beta_plus"))
    return rounded(ex.site_summary(s, 0.05))


@query("class_distribution", "SELECT coalesce(source, 'ALL') AS source, lang, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source, lang), (lang))")
def class_distribution(t):
    return ex.class_distribution(t.documents, "source", "lang")


@query("assembly_quality_audit", """
WITH a AS (SELECT o_orderkey k, o_orderpriority c, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 0 ELSE floor(o_totalprice) END len, o_custkey n50 FROM orders WHERE o_custkey > 0), m AS (SELECT c, median(len) m FROM a WHERE len > 0 GROUP BY 1 HAVING count(*) >= 100)
SELECT k, CASE WHEN len > 0 THEN round(len / m * 100, 1) END AS pct_of_median, CASE WHEN len <= 0 THEN 'UNASSESSED_no_size' WHEN m IS NULL THEN 'UNASSESSED_small_clade' WHEN len < m * 0.3 AND n50 < 200 THEN 'FLAG_unusable' WHEN len < m * 0.3 THEN 'watch_small_but_contiguous' WHEN n50 < 200 THEN 'watch_fragmented_but_complete' ELSE 'ok' END AS verdict
FROM a LEFT JOIN m USING (c)""")
def assembly_quality_audit(t):
    a = t.orders.where("o_custkey > 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("clade"),
                                               F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0), 0).otherwise(F.floor("o_totalprice")).alias("length"), F.col("o_custkey").alias("n50"))
    return ex.assembly_quality_audit(a, 100, 0.3, 200).select("k", "pct_of_median", "verdict")


@query("duplicate_accessions", "SELECT split_part(id, '.', 1) AS base, count(*) AS n FROM (SELECT 'G' || (o_custkey % 900) || '.' || o_orderkey id FROM orders) GROUP BY 1 HAVING count(*) > 1")
def duplicate_accessions(t):
    a = t.orders.select(F.concat(F.lit("G"), (F.col("o_custkey") % 900).cast("string"), F.lit("."), F.col("o_orderkey").cast("string")).alias("id"))
    return ex.duplicate_accessions(a, sc.base_accession(F.col("id")))


@query("anchor_verdict_summary", "SELECT p_brand AS brand, count(*) FILTER (p_size <= 20) AS n_keep, count(*) FILTER (p_size > 20 AND p_size < 40) AS n_exclude FROM part GROUP BY 1")
def anchor_verdict_summary(t):
    v = t.part.select(F.col("p_brand").alias("brand"), F.when(F.col("p_size") <= 20, "include").when(F.col("p_size") < 40, "exclude").otherwise("?").alias("v"))
    return ex.verdict_summary(v, "brand", "v")


@query("anchor_verdict_lists", """
WITH v AS (SELECT 'v' || p_partkey AS path, CASE WHEN p_size % 11 > 0 THEN p_name END AS class, CASE WHEN p_size <= 20 THEN 'include' WHEN p_size < 40 THEN 'exclude' WHEN p_size < 45 THEN 'open' END AS verdict, p_size FROM part),
l AS (SELECT *, CASE WHEN class IS NULL THEN NULL WHEN verdict = 'include' THEN 'keep' WHEN verdict = 'exclude' THEN 'exclude' END AS list FROM v)
SELECT path, class, verdict, list, CASE WHEN list IS NOT NULL THEN row_number() OVER (PARTITION BY list ORDER BY coalesce(class, ''), path) END AS place,
 '| ' || coalesce(class, '?') || ' | ' || coalesce(verdict, '?') || ' | ' || p_size || ' | ' || printf('%.3f', CASE WHEN p_size % 3 > 0 THEN p_size / 1000.0 ELSE 0 END) || ' | ' || printf('%.1f', p_size / 10.0) || ' | ' || CASE WHEN p_size % 4 > 0 THEN 'far; r' || p_size ELSE '—' END || ' |' AS line FROM l""")
def anchor_verdict_lists(t):
    size = F.col("p_size")
    verdict = F.when(size <= 20, "include").when(size < 40, "exclude").when(size < 45, "open")
    reasons = F.when(size % 4 > 0, F.array(F.lit("far"), F.concat(F.lit("r"), size.cast("string")))).otherwise(F.array().cast("array<string>"))
    text = F.to_json(F.struct(F.when(size % 11 > 0, F.col("p_name")).alias("class"), verdict.alias("verdict"), size.alias("n_infiltrations"),
                              F.when(size % 3 > 0, size / 1000).alias("rf"), (size / 10).alias("support_drop"), reasons.alias("reasons")))
    return ex.verdict_lists(t.part.select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("path"), text.alias("value")))


@query("csv_column_helpers", "SELECT sum(CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 3 = 1 THEN p_size ELSE 0 END)::DOUBLE AS total FROM part")
def csv_column_helpers(t):
    text = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.col("p_size").cast("string")).otherwise("n/a")
    return ex.column_sum(t.part.select(text.alias("x")), "x")


@query("modal_tier_report", "SELECT p_brand AS p_brand, p_type AS p_type, count(*) AS n FROM part GROUP BY 1, 2")
def modal_tier_report(t):
    return lb.modal_tier_report(t.part, "p_brand", "p_type")


@query("percentile_threshold_score", "SELECT c_custkey AS id, CASE WHEN c_acctbal > (SELECT quantile_cont(c_acctbal, 0.75) FROM customer) THEN c_acctbal ELSE 0 END AS score FROM customer")
def percentile_threshold_score(t):
    return ex.percentile_threshold_score(t.customer.select(F.col("c_custkey").alias("id"), "c_acctbal"), "c_acctbal").select("id", "score")
