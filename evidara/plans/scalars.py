"""Scores, names and filters over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.functions import scalars as sc
from evidara.operators import filters as fl
from evidara.plans.registry import query
from evidara.plans.stats import rounded


@query("legacy_column_alias", "SELECT event_id, value AS lse_divergence_score, user_id AS lse_divergence_score_norm FROM events")
def legacy_column_alias(t):
    old = t.events.select("event_id", F.col("value").alias("lse_depth_score"), F.col("user_id").alias("lse_divergence_score_norm"), F.lit(1).alias("lse_depth_score_norm"))
    return sc.legacy_column_alias(old).drop("lse_depth_score_norm")


REF_SQL = """ref AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'OR' || p_size || 'A1_HUMAN' WHEN 1 THEN 'Orexin receptor ' || p_size WHEN 2 THEN 'taar' || p_size
 WHEN 3 THEN 'x|Olfactory receptor ' || p_size WHEN 4 THEN 'Gustatory-like' WHEN 5 THEN 'adrenoceptor beta ' || p_size ELSE p_name END nm FROM part)"""


def ref_names(t):
    s = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 7
    nm = (F.when(k == 0, F.concat(F.lit("OR"), s, F.lit("A1_HUMAN"))).when(k == 1, F.concat(F.lit("Orexin receptor "), s)).when(k == 2, F.concat(F.lit("taar"), s))
          .when(k == 3, F.concat(F.lit("x|Olfactory receptor "), s)).when(k == 4, F.lit("Gustatory-like")).when(k == 5, F.concat(F.lit("adrenoceptor beta "), s)).otherwise(F.col("p_name")))
    return t.part.select("p_partkey", nm.alias("nm"))


@query("reference_category_weight", f"""
WITH {REF_SQL} SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 3.5::DOUBLE WHEN regexp_matches(nm, '{sc.CHEMORECEPTOR_PATTERN}') THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM ref""")
def reference_category_weight(t):
    mapped = F.when(F.col("p_partkey") % 50 == 0, 3.5)
    return ref_names(t).select("p_partkey", sc.reference_category_weight(F.col("nm"), mapped=mapped).alias("weight"))


LABEL_SQL = """lb AS (SELECT l_orderkey tree, l_linenumber node, CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'n' || l_suppkey WHEN 2 THEN (l_tax * 10)::VARCHAR || '/' || floor(l_quantity)::INT
 WHEN 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN floor(l_quantity)::INT::VARCHAR ELSE (l_discount * 10)::VARCHAR END ELSE '0.5//' END lab FROM lineitem)"""


def labels(t):
    k = F.col("l_partkey") % 5
    q = F.floor("l_quantity").cast("string")
    lab = (F.when(k == 0, "").when(k == 1, F.concat(F.lit("n"), F.col("l_suppkey").cast("string")))
           .when(k == 2, F.concat((F.col("l_tax") * 10).cast("string"), F.lit("/"), q))
           .when(k == 3, F.when(F.col("l_orderkey") % 2 == 0, q).otherwise((F.col("l_discount") * 10).cast("string"))).otherwise("0.5//"))
    return t.lineitem.select(F.col("l_orderkey").alias("tree"), F.col("l_linenumber").alias("node"), F.col("l_partkey"), F.col("l_suppkey"), lab.alias("lab"))


PARSED_SQL = LABEL_SQL + """, ps AS (SELECT tree, node, l_partkey, l_suppkey, CASE WHEN l_partkey % 5 = 2 THEN floor(l_quantity) WHEN l_partkey % 5 = 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN floor(l_quantity) ELSE l_discount * 10 END END v,
 CASE WHEN l_partkey % 5 = 2 THEN true WHEN l_partkey % 5 = 3 THEN false END pct FROM (SELECT l_orderkey tree, l_linenumber node, * FROM lineitem))"""


@query("support_label_parse", f"WITH {PARSED_SQL} SELECT tree, node, l_partkey, l_suppkey, round(v, 6) AS value, pct AS is_percent FROM ps")
def support_label_parse(t):
    v, p = sc.support_label_parse(F.col("lab"))
    return labels(t).select("tree", "node", "l_partkey", "l_suppkey", F.round(v, 6).alias("value"), p.alias("is_percent"))


@query("support_scale_resolve", f"""
WITH {PARSED_SQL}, m AS (SELECT tree, max(v) top FROM ps WHERE NOT pct GROUP BY 1)
SELECT tree, node, l_partkey, l_suppkey, round(v * CASE WHEN pct OR top > 1 THEN 1 ELSE 100 END, 4) AS support FROM ps LEFT JOIN m USING (tree) WHERE v IS NOT NULL""")
def support_scale_resolve(t):
    v, p = sc.support_label_parse(F.col("lab"))
    rows = labels(t).select("tree", "node", "l_partkey", "l_suppkey", v.alias("v"), p.alias("pct")).where("v IS NOT NULL")
    return sc.support_scale_resolve(rows, "tree", "v", "pct").select("tree", "node", "l_partkey", "l_suppkey", F.round("support", 4).alias("support"))


@query("min_tm_filter", """
SELECT doc_id AS seq_id, n_chars % 12 AS tm_count, (n_chars % 100) / 100 AS tm_confidence, quality IS NOT NULL AND quality = 1 AS gpcr_positive,
 coalesce(quality = 1, false) AND n_chars % 12 >= 6 AND (n_chars % 100) / 100 >= 0.5 AS passed_gate FROM documents LEFT JOIN labels USING (doc_id)""")
def min_tm_filter(t):
    p = t.documents.select(F.col("doc_id").alias("seq_id"), (F.col("n_chars") % 12).alias("tm_count"), ((F.col("n_chars") % 100) / 100).alias("tm_confidence"))
    return fl.min_tm_filter(p, t.labels.where("quality = 1").select(F.col("doc_id").alias("seq_id")), 6, 0.5)


@query("length_filter_tukey", """
WITH s AS (SELECT n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 k, count(*) OVER () n FROM documents),
q AS (SELECT max(n_chars) FILTER (k = n // 4) q1, max(n_chars) FILTER (k = 3 * n // 4) q3 FROM s)
SELECT doc_id, n_chars FROM documents, q WHERE n_chars >= 200 AND n_chars <= greatest(q3 + 1.5 * (q3 - q1), 800)""")
def length_filter_tukey(t):
    return fl.length_filter_tukey(t.documents.select("doc_id", "n_chars"), "n_chars", 200)


@query("length_filter_max", "SELECT doc_id FROM documents WHERE length(text) <= 2500")
def length_filter_max(t):
    return fl.length_filter_max(t.documents, "text", 2500).select("doc_id")


GAPPED_SQL = "al AS (SELECT c_nationkey aln, c_custkey id, translate(c_name, '#0', '--') AS s FROM customer)"


def gapped(t):
    return t.customer.select(F.col("c_nationkey").alias("aln"), F.col("c_custkey").alias("id"), F.translate("c_name", "#0", "--").alias("s"))


@query("gap_row_filter", f"WITH {GAPPED_SQL} SELECT id FROM al WHERE (length(s) - length(replace(s, '-', ''))) / length(s) < 0.4")
def gap_row_filter(t):
    return fl.gap_row_filter(gapped(t), "s", 0.4).select("id")


@query("alignment_check", f"""
WITH {GAPPED_SQL} SELECT aln, count(*) AS n, min(length(s)) AS min_length, round(sum(length(s) - length(replace(s, '-', ''))) / sum(length(s)) * 100, 6) AS gap_percent,
 min(length(s)) >= 10 AND sum(length(s) - length(replace(s, '-', ''))) / sum(length(s)) * 100 <= 37 AS ok FROM al GROUP BY 1""")
def alignment_check(t):
    return rounded(fl.alignment_check(gapped(t), "aln", "s", 10, 37), 6)


@query("prune_alignment", f"WITH {GAPPED_SQL} SELECT aln, id FROM al WHERE length(s) >= 10 AND (length(s) - length(replace(s, '-', ''))) / length(s) * 100 <= 34")
def prune_alignment(t):
    return fl.prune_alignment(gapped(t), "s", 10, 34).select("aln", "id")


MANIFEST_SQL = "mf AS (SELECT source og, count(*) size, bool_or(lang = 'es' AND n_chars > 5000) has_focal, bool_or(lang = 'de') has_reference FROM documents GROUP BY 1)"


def manifest(t):
    return fl.orthogroup_manifest(t.documents.withColumnRenamed("source", "og"), "og", (F.col("lang") == "es") & (F.col("n_chars") > 5000), F.col("lang") == "de")


@query("orthogroup_manifest", f"WITH {MANIFEST_SQL} SELECT * FROM mf")
def orthogroup_manifest(t):
    return manifest(t)


@query("orthogroup_filter", f"WITH {MANIFEST_SQL} SELECT og FROM mf WHERE size >= 50 AND has_focal AND has_reference")
def orthogroup_filter(t):
    return fl.orthogroup_filter(manifest(t), 50, True, True).select("og")


@query("min_size_groups", "SELECT doc_id FROM documents WHERE (source, lang) IN (SELECT (source, lang) FROM documents GROUP BY source, lang HAVING count(*) >= 10)")
def min_size_groups(t):
    return fl.min_size_groups(t.documents, ["source", "lang"], 10).select("doc_id")


LEVEL_SQL = "CASE l_suppkey % 4 WHEN 0 THEN 'Complete Genome' WHEN 1 THEN 'Chromosome' WHEN 2 THEN 'Scaffold' ELSE 'Contig' END"


@query("assembly_level_filter", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey % 4 <= 1")
def assembly_level_filter(t):
    k = F.col("l_suppkey") % 4
    level = F.when(k == 0, "Complete Genome").when(k == 1, "Chromosome").when(k == 2, "Scaffold").otherwise("Contig")
    return t.lineitem.where(sc.assembly_level_filter(level, "Chromosome")).select("l_orderkey", "l_linenumber", "l_suppkey")


KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("selection_score", """
WITH r AS (SELECT *, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity / 20 END w FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN w < 1 THEN abs(log10(greatest(w, 1e-9))) * 0.5 * CASE WHEN l_discount < 0.05 THEN 1.5 ELSE 1 END ELSE 0 END, 9) AS purifying,
 round(CASE WHEN w > 1 THEN log10(w) * CASE WHEN l_discount < 0.05 THEN 1.5 ELSE 1 END ELSE 0 END, 9) AS positive, w IS NOT NULL AND l_discount < 0.05 AS significant FROM r""")
def selection_score(t):
    w = F.when(F.col("l_quantity") <= 45, F.col("l_quantity") / 20)
    pur, pos, sig = sc.selection_score(w, F.col("l_discount"), purifying_weight=0.5)
    return t.lineitem.select(*KEY, F.round(pur, 9).alias("purifying"), F.round(pos, 9).alias("positive"), sig.alias("significant"))


@query("tandem_score", "SELECT l_orderkey, l_linenumber, l_partkey, round(ln(1 + CASE WHEN l_tax > 0.02 THEN l_quantity END) / ln(21), 9) AS score FROM lineitem")
def tandem_score(t):
    return t.lineitem.select(*KEY, F.round(sc.tandem_score(F.when(F.col("l_tax") > 0.02, F.col("l_quantity"))), 9).alias("score"))


@query("synteny_log_norm", """
WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') c FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN c > 0 THEN round(ln(1 + c) / ln(1 + (SELECT max(c) FROM c)), 9) ELSE 0 END AS score FROM c""")
def synteny_log_norm(t):
    c = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("c"))
    return rounded(sc.synteny_log_norm(c, "c", "score").drop("c"))


@query("chemo_expression_score", """
WITH r AS (SELECT *, (l_quantity * 2.0 + l_tax * 100) / 3.0 m, l_discount * 10 tau, l_extendedprice / 10000 en, l_returnflag = 'A' sp FROM lineitem),
s AS (SELECT *, least(log2(1 + m) / 7, 1) * 0.4 + tau * 0.3 + CASE WHEN en > 1 THEN least(log2(en) / 5, 1) * 0.3 ELSE 0 END b FROM r)
SELECT l_orderkey, l_linenumber, l_partkey, round(b * CASE WHEN NOT sp THEN 1 WHEN l_quantity > 0 AND l_quantity >= l_tax * 100 THEN 1.75 ELSE 1.5 END, 6) AS score FROM s""")
def chemo_expression_score(t):
    w = sc.tissue_weights(["rhinophore", "oral_veil"], "rhinophore:2.0,oral_veil:1.0")
    tpm = {"rhinophore": F.col("l_quantity"), "oral_veil": F.col("l_tax") * 100}
    s = sc.chemo_expression_score(tpm, w, F.col("l_discount") * 10, F.col("l_extendedprice") / 10000, F.col("l_returnflag") == "A", "rhinophore")
    return t.lineitem.select(*KEY, F.round(s, 6).alias("score"))


@query("gprotein_score", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * CASE WHEN l_returnflag IN ('A', 'N') THEN 1.5 ELSE 1 END AS score FROM lineitem")
def gprotein_score(t):
    kind = F.when(F.col("l_returnflag") == "A", "Golf").when(F.col("l_returnflag") == "N", "Go").otherwise("Gq")
    return t.lineitem.select(*KEY, sc.gprotein_score(F.col("l_quantity"), kind).alias("score"))


@query("ecl_score", "SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_quantity / 7 >= 2 THEN least(l_quantity / 14, 3) ELSE l_quantity / 14 * 0.5 END, 9) AS score FROM lineitem")
def ecl_score(t):
    return t.lineitem.select(*KEY, F.round(sc.ecl_score(F.col("l_quantity") / 7), 9).alias("score"))


@query("expansion_score", """
SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_tax > 0 AND l_tax < 1 THEN -log10(l_tax) ELSE 0 END * CASE WHEN l_returnflag = 'R' THEN 1.5 ELSE 1 END
 * CASE WHEN l_quantity / 10 > 2 THEN least(l_quantity / 20, 2) ELSE 1 END, 9) AS score FROM lineitem""")
def expansion_score(t):
    return rounded(t.lineitem.select(*KEY, sc.expansion_score(F.col("l_tax"), F.col("l_returnflag"), F.col("l_quantity") / 10, ["R"]).alias("score")))


@query("expression_score", """
SELECT l_orderkey, l_linenumber, l_partkey, round(least(0.4 * least(ln(1 + l_extendedprice) / 10, 1) + 0.4 * coalesce(CASE WHEN l_tax > 0.01 THEN l_discount * 10 END, 0)
 + CASE WHEN l_returnflag = 'A' THEN 0.3 WHEN l_quantity / 10 > 1.5 THEN 0.1 ELSE 0 END, 1), 9) AS score FROM lineitem""")
def expression_score(t):
    tau = F.when(F.col("l_tax") > 0.01, F.col("l_discount") * 10)
    return rounded(t.lineitem.select(*KEY, sc.expression_score(F.col("l_extendedprice"), tau, F.col("l_returnflag") == "A", F.col("l_quantity") / 10).alias("score")))


@query("selection_concordance_boost", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * CASE WHEN l_discount < 0.05 AND l_returnflag = 'A' THEN 1.3 WHEN l_discount < 0.05 AND l_linestatus = 'F' THEN 1.15 ELSE 1 END
 * CASE WHEN l_discount < 0.05 AND l_linenumber > 3 THEN 1.1 ELSE 1 END, 9) AS score FROM lineitem""")
def selection_concordance_boost(t):
    s = sc.selection_concordance_boost(F.col("l_quantity"), F.col("l_discount") < 0.05, F.col("l_returnflag") == "A", F.col("l_linestatus") == "F", F.col("l_linenumber") - 3)
    return rounded(t.lineitem.select(*KEY, s.alias("score")))


@query("hcr_friendly", """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CASE WHEN l_linenumber < 7 THEN l_quantity * 40 END >= 600, false) AND coalesce(CASE WHEN l_returnflag <> 'N' THEN l_discount * 10 END <= 0.8, true)
 AND coalesce(CASE WHEN l_linestatus = 'F' THEN l_linenumber END < 5, true) AS friendly FROM lineitem""")
def hcr_friendly(t):
    f = sc.hcr_friendly(F.when(F.col("l_linenumber") < 7, F.col("l_quantity") * 40), F.when(F.col("l_returnflag") != "N", F.col("l_discount") * 10),
                        F.when(F.col("l_linestatus") == "F", F.col("l_linenumber")))
    return t.lineitem.select(*KEY, f.alias("friendly"))


@query("microswitch_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax * 10 >= 0.4 AND l_linenumber > 1 THEN (l_returnflag = 'N' AND l_linestatus = 'F')::INT END AS or_microswitch FROM lineitem""")
def microswitch_flag(t):
    toggle = F.when(F.col("l_returnflag") == "N", " y ").otherwise("W")
    anchor = F.when(F.col("l_linestatus") == "F", "P").otherwise("A")
    full = F.create_map(F.lit("6.48"), toggle, F.lit("6.50"), anchor)
    part = F.create_map(F.lit("6.48"), toggle)
    res = F.when(F.col("l_linenumber") > 1, full).otherwise(part)
    return t.lineitem.select(*KEY, sc.microswitch_flag(res, F.col("l_tax") * 10).alias("or_microswitch"))


@query("small_molecule_score", """
WITH r AS (SELECT *, CASE WHEN l_returnflag <> 'A' THEN greatest(0, least(1, (20 - l_quantity) / 10)) END a, CASE WHEN l_linestatus = 'F' THEN greatest(0, least(1, (1200 - l_extendedprice / 40) / 600)) END b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce((a + b) / 2, a, b), 9) AS score FROM r""")
def small_molecule_score(t):
    s = sc.small_molecule_score(F.when(F.col("l_returnflag") != "A", F.col("l_quantity")), F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice") / 40))
    return rounded(t.lineitem.select(*KEY, s.alias("score")))


_COMP = ", ".join(f"length(text) - length(translate(text, '{a}{a.lower()}', ''))" for a in sc.AMINO_ACIDS)


@query("aa_composition", f"""
WITH c AS (SELECT doc_id, [{_COMP}] v FROM documents), e AS (SELECT doc_id, unnest(v) n, unnest(range(20)) i, list_sum(v) t FROM c)
SELECT doc_id, i::INTEGER AS i, CASE WHEN t > 0 THEN round(n / t, 9) ELSE 0 END AS share FROM e""")
def aa_composition(t):
    return t.documents.select("doc_id", F.posexplode(sc.aa_composition(F.col("text"))).alias("i", "share")).select("doc_id", "i", F.round("share", 9).alias("share"))


@query("pairwise_identity", """
WITH p AS (SELECT a.c_custkey k, translate(a.c_name, '#0', '--') x, translate(b.c_name, '#0', '--') y FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 7),
c AS (SELECT k, substr(x, i::INT, 1) cx, substr(y, i::INT, 1) cy FROM p, generate_series(1, 18) g(i))
SELECT k, round(count(*) FILTER (cx = cy) / count(*), 9) AS identity FROM c WHERE cx NOT IN ('-', '.') AND cy NOT IN ('-', '.') GROUP BY 1""")
def pairwise_identity(t):
    a = gapped(t).select(F.col("id").alias("k"), F.col("s").alias("x"))
    b = gapped(t).select((F.col("id") - 7).alias("k"), F.col("s").alias("y"))
    return a.join(b, "k").select("k", F.round(sc.pairwise_identity(F.col("x"), F.col("y")), 9).alias("identity"))


HEAD_SQL = """h AS (SELECT p_partkey, p_size, CASE p_partkey % 6 WHEN 0 THEN p_size || '_Genus_sp' WHEN 1 THEN 'aplcal_XP' || p_size WHEN 2 THEN 'sp|P' || p_size || '|NAME' WHEN 3 THEN 'gi|123|ref|NP' || p_size
 WHEN 4 THEN 'verylongheader' || p_size ELSE 'x' END hd, CASE WHEN p_partkey % 4 = 0 THEN 'OS=Homo sapiens OX=9606 GN=ABC' || p_size WHEN p_partkey % 4 = 1 THEN 'OS=Mus GN=G' ELSE 'gene:xyz [Limax maximus]' END de FROM part)"""


def headers(t):
    s = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 6
    hd = (F.when(k == 0, F.concat(s, F.lit("_Genus_sp"))).when(k == 1, F.concat(F.lit("aplcal_XP"), s)).when(k == 2, F.concat(F.lit("sp|P"), s, F.lit("|NAME")))
          .when(k == 3, F.concat(F.lit("gi|123|ref|NP"), s)).when(k == 4, F.concat(F.lit("verylongheader"), s)).otherwise("x"))
    q = F.col("p_partkey") % 4
    de = F.when(q == 0, F.concat(F.lit("OS=Homo sapiens OX=9606 GN=ABC"), s)).when(q == 1, "OS=Mus GN=G").otherwise("gene:xyz [Limax maximus]")
    return t.part.select("p_partkey", "p_size", hd.alias("hd"), de.alias("de"))


@query("taxid_from_header", f"""
WITH {HEAD_SQL} SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '9606' WHEN p_partkey % 6 = 0 THEN p_size::VARCHAR WHEN p_partkey % 6 = 1 THEN 'aplcal' WHEN p_partkey % 4 = 1 THEN 'mus'
 WHEN p_partkey % 6 = 2 THEN 'sp' WHEN p_partkey % 6 = 3 THEN 'gi' WHEN p_partkey % 6 = 4 THEN 'verylonghe' ELSE 'x' END AS taxid,
 CASE p_partkey % 4 WHEN 0 THEN 'Homo sapiens' WHEN 1 THEN 'Mus' ELSE 'Limax maximus' END AS species,
 CASE p_partkey % 4 WHEN 0 THEN 'ABC' || p_size WHEN 1 THEN 'G' ELSE 'xyz' END AS gene FROM h""")
def taxid_from_header(t):
    h, d = F.col("hd"), F.col("de")
    return headers(t).select("p_partkey", sc.taxid_from_header(h, d).alias("taxid"), sc.species_from_header(h, d).alias("species"), sc.gene_from_header(h, d).alias("gene"))


FAM_SQL = """f AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'C-C chemokine receptor type ' || p_size WHEN 1 THEN 'Gonadotropin-releasing hormone receptor' WHEN 2 THEN 'Follitropin receptor'
 WHEN 3 THEN 'Adenosine receptor A' || p_size WHEN 4 THEN 'Prostaglandin E2 receptor' WHEN 5 THEN 'GCR' || p_size WHEN 6 THEN 'Opsin-' || p_size ELSE p_name END nm,
 CASE WHEN p_partkey % 3 = 0 THEN 'CCR' || p_size WHEN p_partkey % 3 = 1 THEN 'P2RY5' ELSE '' END gn,
 CASE WHEN p_partkey % 3 = 0 THEN 'Belongs to the G-protein coupled receptor 2 family.' WHEN p_partkey % 3 = 1 THEN 'Belongs to the G protein coupled receptor 9 family' ELSE '' END sim,
 CASE WHEN p_partkey % 2 = 0 THEN 'PF12345;PF00003;PF00001;' ELSE '' END dom FROM part)"""


def receptors(t):
    s = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 8
    nm = (F.when(k == 0, F.concat(F.lit("C-C chemokine receptor type "), s)).when(k == 1, "Gonadotropin-releasing hormone receptor").when(k == 2, "Follitropin receptor")
          .when(k == 3, F.concat(F.lit("Adenosine receptor A"), s)).when(k == 4, "Prostaglandin E2 receptor").when(k == 5, F.concat(F.lit("GCR"), s))
          .when(k == 6, F.concat(F.lit("Opsin-"), s)).otherwise(F.col("p_name")))
    m = F.col("p_partkey") % 3
    return t.part.select(
        "p_partkey", nm.alias("nm"), F.when(m == 0, F.concat(F.lit("CCR"), s)).when(m == 1, "P2RY5").otherwise("").alias("gn"),
        F.when(m == 0, "Belongs to the G-protein coupled receptor 2 family.").when(m == 1, "Belongs to the G protein coupled receptor 9 family").otherwise("").alias("sim"),
        F.when(F.col("p_partkey") % 2 == 0, "PF12345;PF00003;PF00001;").otherwise("").alias("dom"))


@query("family_regex_classify", f"""
WITH {FAM_SQL} SELECT p_partkey, CASE WHEN p_partkey % 8 = 1 THEN '' WHEN p_partkey % 8 = 0 THEN 'chemokine' WHEN p_partkey % 8 = 2 THEN 'glycoprotein-hormone' WHEN p_partkey % 8 = 3 THEN 'nucleotide'
 WHEN p_partkey % 8 = 4 THEN 'lipid' WHEN p_partkey % 3 = 0 THEN 'chemokine' WHEN p_partkey % 3 = 1 THEN 'nucleotide' ELSE '' END AS family,
 CASE WHEN p_partkey % 3 = 0 THEN 'B' WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'UNKNOWN' END AS class FROM f""")
def family_regex_classify(t):
    return receptors(t).select("p_partkey", sc.family_regex_classify(F.col("nm"), F.col("gn")).alias("family"), sc.class_from_evidence(F.col("sim"), F.col("dom")).alias("class"))


@query("name_asserts_function", f"""
WITH {FAM_SQL} SELECT p_partkey, nm, NOT regexp_matches(nm, '(?i){sc.UNCHARACTERIZED}') AND NOT regexp_matches(nm, '(?i){sc.PLACEHOLDER}')
 AND NOT (regexp_matches(nm, '{sc.ABBREVIATION_WITH_NUMBER}') AND NOT regexp_matches(nm, '(?i){sc.FUNCTION_WORD}')) AS asserts FROM f""")
def name_asserts_function(t):
    return receptors(t).select("p_partkey", "nm", sc.name_asserts_function(F.col("nm")).alias("asserts"))


GENOME_SQL = """chrom AS (SELECT p_partkey, p_size, translate(md5(p_name || p_partkey) || md5(p_brand || p_partkey), '0123456789abcdef', 'ACGTACGTACGTACGT') s FROM part),
ex AS (SELECT p_partkey, p_size % 2 = 0 minus, substr(s, 1 + p_size % 5, 12) || substr(s, 21, 4 + p_size % 7) j FROM chrom),
cd AS (SELECT p_partkey, j, CASE WHEN minus THEN reverse(translate(j, 'ACGT', 'TGCA')) ELSE j END r FROM ex),
tr AS (SELECT p_partkey, j, substr(r, 1, length(r) // 3 * 3) c FROM cd),
cods AS (SELECT p_partkey, c, i, substr(c, (i * 3 + 1)::INT, 3) cod, length(c) // 3 n FROM tr, generate_series(0, 9) g(i) WHERE i < length(c) // 3),
ok AS (SELECT p_partkey, c, count(*) FILTER (i < n - 1 AND cod IN ('TAA', 'TAG', 'TGA')) bad FROM cods GROUP BY 1, 2)"""


@query("cds_splice", f"WITH {GENOME_SQL} SELECT p_partkey, CASE WHEN bad = 0 THEN c END AS cds FROM ok")
def cds_splice(t):
    seq = F.translate(F.concat(F.md5(F.concat("p_name", F.col("p_partkey").cast("string"))), F.md5(F.concat("p_brand", F.col("p_partkey").cast("string")))), "0123456789abcdef", "ACGTACGTACGTACGT")
    a = F.struct((1 + F.col("p_size") % 5).alias("start"), (12 + F.col("p_size") % 5).alias("end"))
    b = F.struct(F.lit(21).alias("start"), (24 + F.col("p_size") % 7).alias("end"))
    return t.part.select("p_partkey", sc.splice_cds(seq, F.array(b, a), F.when(F.col("p_size") % 2 == 0, "-").otherwise("+")).alias("cds"))


_AA = "CASE cod " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sc.codon_table().items()) + " END"


@query("cds_translate", f"""
WITH {GENOME_SQL} SELECT p_partkey, rtrim(string_agg({_AA}, '' ORDER BY i), '*') AS protein FROM cods GROUP BY 1""")
def cds_translate(t):
    seq = F.translate(F.concat(F.md5(F.concat("p_name", F.col("p_partkey").cast("string"))), F.md5(F.concat("p_brand", F.col("p_partkey").cast("string")))), "0123456789abcdef", "ACGTACGTACGTACGT")
    joined = F.concat(F.substr(seq, 1 + F.col("p_size") % 5, F.lit(12)), F.substr(seq, F.lit(21), 4 + F.col("p_size") % 7))
    r = F.when(F.col("p_size") % 2 == 0, sc.reverse_complement(joined)).otherwise(joined)
    return t.part.select("p_partkey", sc.translate_cds(r).alias("protein"))


@query("file_name_fields", """
SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN p_size::BIGINT END AS taxid, CASE WHEN p_partkey % 3 < 2 THEN replace(p_name, '_', ' ') END AS binomial FROM part""")
def file_name_fields(t):
    s = F.col("p_size").cast("string")
    nm = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    k = F.col("p_partkey") % 3
    path = F.when(k == 0, F.concat(F.lit("/data/"), s, F.lit("_"), nm, F.lit(".aa.fna"))).when(k == 1, F.concat(s, F.lit("_"), nm, F.lit(".fa"))).otherwise(F.concat(F.lit("x_"), nm, F.lit(".fa")))
    a, b = sc.file_name_fields(path)
    return t.part.select("p_partkey", a.alias("taxid"), b.alias("binomial"))


@query("namespace_ids", "SELECT doc_id, source || '|' || doc_id AS id FROM documents")
def namespace_ids(t):
    return t.documents.select("doc_id", sc.namespace_ids(F.col("source"), F.col("doc_id").cast("string")).alias("id"))


@query("sanitize_name", "SELECT page_id, regexp_replace(regexp_replace(regexp_replace(trim(url), '[^A-Za-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') AS name FROM pages")
def sanitize_name(t):
    return t.pages.select("page_id", sc.sanitize_name(F.col("url")).alias("name"))


@query("id_canonicalize", """
WITH r AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'dir/' || c_name || '.cif.gz' WHEN 1 THEN c_name || '_A' WHEN 2 THEN c_name ELSE 'Unknown' || c_custkey || '.pdb' END raw, c_name, c_mktsegment FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 < 3 AND c_mktsegment <> 'BUILDING' THEN c_name END AS canonical FROM r""")
def id_canonicalize(t):
    k = F.col("c_custkey") % 4
    raw = (F.when(k == 0, F.concat(F.lit("dir/"), "c_name", F.lit(".cif.gz"))).when(k == 1, F.concat("c_name", F.lit("_A"))).when(k == 2, F.col("c_name"))
           .otherwise(F.concat(F.lit("Unknown"), F.col("c_custkey").cast("string"), F.lit(".pdb"))))
    return sc.id_canonicalize(t.customer.select("c_custkey", raw.alias("raw")), "raw", t.customer.where("c_mktsegment <> 'BUILDING'"), "c_name").select("c_custkey", "canonical")


@query("target_keys", """
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'db/AF-P' || p_partkey || '-F1-model_v4.cif.gz' ELSE '1ab' || (p_size % 10) || '_A.pdb' END raw, p_size % 10 d FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN raw || ',' || substr(raw, 4) || ',' || replace(substr(raw, 4), '.cif.gz', '') || ',P' || p_partkey
 ELSE raw || ',1ab' || d || '_A,1ab' || d || ',1AB' || d || ',1AB' || d || '_A' END AS keys FROM r""")
def target_keys(t):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("db/AF-P"), F.col("p_partkey").cast("string"), F.lit("-F1-model_v4.cif.gz"))).otherwise(
        F.concat(F.lit("1ab"), (F.col("p_size") % 10).cast("string"), F.lit("_A.pdb")))
    return t.part.select("p_partkey", F.array_join(sc.target_keys(raw), ",").alias("keys"))


@query("base_accession", "SELECT p_partkey, 'GCA_' || p_partkey AS base FROM part")
def base_accession(t):
    acc = F.concat(F.lit(" GCA_"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") > 20, ".2").otherwise(""))
    return t.part.select("p_partkey", sc.base_accession(acc).alias("base"))


@query("reliability_flag", "SELECT o_custkey, CASE WHEN count(*) >= 10 THEN 'high' WHEN count(*) >= 5 THEN 'medium' ELSE 'low' END AS flag FROM orders GROUP BY 1")
def reliability_flag(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).select("o_custkey", sc.reliability_flag(F.col("n")).alias("flag"))


from evidara.operators import labels as lb  # noqa: E402
from evidara.plans.labels import CALLS_SQL, three_calls  # noqa: E402


@query("needs_manual_review", f"""
WITH {CALLS_SQL} SELECT id, CASE WHEN classification = 'chemoreceptor-candidate' AND raw = '' AND o IN ('', 'unclassified-og') THEN 'yes' ELSE 'no' END AS review FROM cons JOIN j USING (id)""")
def needs_manual_review(t):
    got = lb.consensus_three_way(*three_calls(t))
    return got.select("id", sc.needs_manual_review(F.col("classification"), F.col("classification_evidence")).alias("review"))


@query("exclusion_power", """
SELECT p_partkey, round(1 - pow(1 - p_retailprice / 10000, p_size), 9) AS power, round(CASE WHEN p_size <= 1 THEN p_size ELSE p_size / (1 + (p_size - 1) * 0.3) END, 9) AS n_eff FROM part""")
def exclusion_power(t):
    return rounded(t.part.select("p_partkey", sc.exclusion_power(F.col("p_size"), F.col("p_retailprice") / 10000).alias("power"),
                                 sc.effective_size(F.col("p_size"), F.lit(0.3)).alias("n_eff")))


@query("shuffle_residues", "SELECT doc_id, length(text) AS n, length(text) - length(replace(text, 'e', '')) AS n_e, length(text) - length(replace(text, ' ', '')) AS n_space FROM documents")
def shuffle_residues(t):
    s = sc.shuffle_residues(F.col("text"), 0.5, 7, F.col("doc_id"))
    d = t.documents.select("doc_id", s.alias("s"))
    return d.select("doc_id", F.length("s").alias("n"), (F.length("s") - F.length(F.replace("s", F.lit("e"), F.lit("")))).alias("n_e"),
                    (F.length("s") - F.length(F.replace("s", F.lit(" "), F.lit("")))).alias("n_space"))
