"""Text made from the given tables in each format, read back by its parser.

The text is a column of a DataFrame here; files go through the same parsers (see the
tests and ``fasta_round_trip``, which writes to the shared folder and reads it again).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from evidara.operators import trees as tr
from evidara.plans.registry import query
from evidara.plans.stats import rounded
from evidara.session import shared_dir
from evidara.sources import nested as ns
from evidara.sources import sinks as sk
from evidara.sources import text as tx


def s(col):
    return F.col(col).cast("string")


def joined(sep, *cols):
    return F.concat_ws(sep, *[c if not isinstance(c, str) else F.col(c) for c in cols])


def fasta_text(t):
    return t.customer.select(F.concat(F.lit(">c"), s("c_custkey"), F.lit(" "), F.col("c_mktsegment"), F.lit(" OX="), s("c_nationkey"), F.lit("\n"), F.substring(F.md5("c_name"), 1, 20), F.lit("\n"), F.col("c_name")).alias("value"))


FASTA_SQL = "SELECT 'c' || c_custkey AS id, c_mktsegment || ' OX=' || c_nationkey AS descr, substr(md5(c_name), 1, 20) || c_name AS seq FROM customer"


@query("scan_fasta", FASTA_SQL)
def scan_fasta(t):
    return tx.scan_fasta(fasta_text(t))


@query("fasta_round_trip", FASTA_SQL.replace("substr(md5(c_name), 1, 20) || c_name", "c_name || c_mktsegment"))
def fasta_round_trip(t):
    path = f"{shared_dir(t.spark)}/fasta-{uuid.uuid4().hex}"
    rows = t.customer.select(F.concat(F.lit("c"), s("c_custkey"), F.lit(" "), F.col("c_mktsegment"), F.lit(" OX="), s("c_nationkey")).alias("id"), F.concat("c_name", "c_mktsegment").alias("seq"))
    sk.write_fasta(rows, path)
    return tx.read_fasta(t.spark, path).drop("path")


@query("scan_aligned_fasta", "SELECT 'c' || c_custkey AS id, length(replace(translate(c_name, '#0', '--'), '-', '')) AS length FROM customer")
def scan_aligned_fasta(t):
    rec = t.customer.select(F.concat(F.lit(">c"), s("c_custkey"), F.lit("\n"), F.translate("c_name", "#0", "--")).alias("value"))
    return tx.sequence_lengths(tx.scan_fasta(rec))


@query("scan_orthogroups", "SELECT 'OG' || l_orderkey AS og, l_returnflag AS species, 'g' || l_partkey AS gene FROM lineitem")
def scan_orthogroups(t):
    g = t.lineitem.groupBy(F.concat(F.lit("OG"), s("l_orderkey")).alias("og")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.array_join(F.collect_list(F.concat(F.lit("g"), s("l_partkey"))), ", "))
    return tx.scan_orthogroups(g, "og")


@query("scan_quant_tree", """
SELECT CASE l_linenumber % 3 WHEN 0 THEN 'sp' || l_suppkey ELSE 'default' END AS species, 'tissue' || l_returnflag AS tissue, CASE l_linenumber % 3 WHEN 0 THEN 'r1' WHEN 1 THEN 'r2' ELSE 'tissue' || l_returnflag || '_SRR' || l_orderkey END AS replicate,
 'g' || l_partkey AS gene, l_quantity AS tpm FROM lineitem""")
def scan_quant_tree(t):
    tis = F.concat(F.lit("tissue"), F.col("l_returnflag"))
    k = F.col("l_linenumber") % 3
    path = F.when(k == 0, F.concat_ws("/", F.lit("/data/quant"), F.concat(F.lit("sp"), s("l_suppkey")), tis, F.lit("r1"), F.lit("quant.sf"))).when(
        k == 1, F.concat_ws("/", F.lit("/data/quant"), tis, F.lit("r2"), F.lit("quant.sf"))).otherwise(
        F.concat(F.lit("/data/quant/"), tis, F.lit("_SRR"), s("l_orderkey"), F.lit("/quant.sf")))
    row = F.concat_ws("\t", F.concat(F.lit("g"), s("l_partkey")), F.lit("100"), F.lit("90.5"), s("l_quantity"), F.lit("7"))
    head = t.lineitem.select(path.alias("path"), F.lit("Name\tLength\tEffectiveLength\tTPM\tNumReads").alias("value"))
    return tx.scan_quant_tree(t.lineitem.select(path.alias("path"), row.alias("value")).unionByName(head), "/data/quant")


@query("scan_hmm_tblout", "SELECT p_type AS target, 'PF' || p_size AS accession, 'q' || p_partkey AS query, p_retailprice / 1e6 AS evalue, p_retailprice AS score FROM part WHERE p_size % 5 > 0")
def scan_hmm_tblout(t):
    return tx.scan_hmm_tblout(hmm_lines(t))


def hmm_lines(t):
    row = F.concat_ws("   ", F.col("p_type"), F.concat(F.lit("PF"), s("p_size"), F.lit(".12")), F.concat(F.lit("q"), s("p_partkey")), F.lit("-"),
                      F.when(F.col("p_size") % 5 > 0, (F.col("p_retailprice") / 1e6).cast("string")).otherwise("n/a"), s("p_retailprice"), F.lit("0.1 1 2"))
    return t.part.select(row.alias("value")).unionByName(t.region.select(F.concat(F.lit("# "), "r_name").alias("value"))).unionByName(t.region.select(F.lit("short row").alias("value")))


@query("scan_foldseek", """
WITH h AS (SELECT 'q' || l_orderkey q, 't' || l_partkey t, l_discount f, l_quantity / 50 a, l_tax e, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity / 50 DESC, l_linenumber * 100000 + l_partkey) k FROM lineitem WHERE l_returnflag <> 'R')
SELECT q AS query, t AS target, f AS fident, a AS alntmscore, e AS evalue FROM h WHERE k = 1""")
def scan_foldseek(t):
    row = F.concat_ws("\t", F.concat(F.lit("q"), s("l_orderkey")), F.concat(F.lit("t"), s("l_partkey")), s("l_discount"),
                      F.when(F.col("l_returnflag") == "R", "nan?").otherwise((F.col("l_quantity") / 50).cast("string")), s("l_tax"))
    lines = t.lineitem.select(row.alias("value"), (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("pos"))
    return tx.best_foldseek(tx.scan_foldseek(lines))


@query("scan_paf", """
SELECT 't' || l_orderkey AS query, 'chr' || l_suppkey AS chrom, l_partkey AS start, l_partkey + 500 AS "end", '+' AS strand, round(CASE l_linenumber % 3 WHEN 0 THEN 100 * (1 - l_discount) WHEN 1 THEN 100 * (1 - l_tax) ELSE 100.0 * (20 + l_quantity + 4) / (20 + l_quantity + 4 + 1 + 3 + 2) END, 6) AS identity,
 100.0 * l_quantity / 50 AS coverage, 'minimap2' AS method, 60.0::DOUBLE AS score FROM lineitem""")
def scan_paf(t):
    return tx.scan_paf(paf_lines(t)).withColumn("identity", F.round("identity", 6))


def paf_lines(t):
    q = F.col("l_quantity").cast("int").cast("string")
    k = F.col("l_linenumber") % 3
    tag = F.when(k == 0, F.concat(F.lit("tp:A:P\tdv:f:0.5\tde:f:"), s("l_discount"))).when(k == 1, F.concat(F.lit("dv:f:"), s("l_tax"))).otherwise(
        F.concat(F.lit("cs:Z::20*ac+ttt:"), q, F.lit("~gt100ag-cc=ACGT")))
    row = F.concat_ws("\t", F.concat(F.lit("t"), s("l_orderkey")), F.lit("50"), F.lit("0"), q, F.lit("+"), F.concat(F.lit("chr"), s("l_suppkey")), F.lit("100000"), s("l_partkey"),
                      (F.col("l_partkey") + 500).cast("string"), F.lit("30"), F.lit("900"), F.lit("60"), tag)
    return t.lineitem.select(row.alias("value"))


@query("scan_blast_tab", """
SELECT 'q' || l_orderkey AS query, l_suppkey::VARCHAR AS subject, l_discount * 1000 AS identity, l_quantity AS coverage, l_tax AS evalue, l_extendedprice AS score, s_name AS chrom, s_nationkey AS start FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_suppkey % 3 = 0""")
def scan_blast_tab(t):
    row = F.concat_ws("\t", F.concat(F.lit("q"), s("l_orderkey")), s("l_suppkey"), (F.col("l_discount") * 1000).cast("string"), *[F.lit("1")] * 7, s("l_tax"), s("l_extendedprice"), s("l_quantity"))
    co = t.supplier.where("s_suppkey % 3 = 0").select(s("s_suppkey").alias("subject"), F.col("s_name").alias("chrom"), F.col("s_nationkey").alias("start"))
    return tx.scan_blast_tab(t.lineitem.select(row.alias("value")), co)


@query("scan_gff", """
SELECT 'q' || l_orderkey AS query, 'chr' || l_suppkey AS chrom, l_partkey AS start, l_partkey + 300 AS "end", l_linestatus AS strand, round(l_discount * 100, 6) AS identity, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END AS coverage, 'miniprot' AS method FROM lineitem WHERE l_returnflag = 'A'""")
def scan_gff(t):
    return rounded(tx.gff_placements(tx.scan_gff(gff_lines(t)), "miniprot", True), 6)


def gff_lines(t):
    att = F.concat(F.lit("ID=x"), s("l_partkey"), F.lit(";Target=q"), s("l_orderkey"), F.lit(" 1 99;Identity="), s("l_discount"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("; coverage="), s("l_quantity"))).otherwise(""), F.lit(";partial=true"))
    kind = F.when(F.col("l_returnflag") == "A", "mRNA").otherwise("CDS")
    row = F.concat_ws("\t", F.concat(F.lit("chr"), s("l_suppkey")), F.lit("miniprot"), kind, (F.col("l_partkey") + 1).cast("string"), (F.col("l_partkey") + 300).cast("string"), F.lit("."), F.col("l_linestatus"), F.lit("."), att)
    return t.lineitem.select(row.alias("value")).unionByName(t.region.select(F.lit("##gff-version 3").alias("value")))


def order_files(t, line, sep="\n", head=None):
    """One text per order: its lines in order (an order has few lines)."""
    g = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"))).alias("x"))
    body = F.array_join(F.transform("x", line), sep)
    return g.select(F.concat(F.lit("f"), s("l_orderkey")).alias("path"), (F.concat(head, body) if head is not None else body).alias("value"))


def one(x, n):
    return x[n].cast("string")


@query("scan_anchor_blocks", """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) r FROM lineitem), b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_tax, l_returnflag, sum((l_returnflag = 'R')::INT) OVER (PARTITION BY l_orderkey ORDER BY r) b FROM l),
k AS (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY b) d FROM b WHERE l_returnflag <> 'R')
SELECT 'f' || l_orderkey AS path, d AS block, 'a' || l_partkey AS gene_a, 'b' || l_suppkey AS gene_b, CASE WHEN l_returnflag = 'A' THEN l_tax ELSE 'nan'::DOUBLE END AS evalue FROM k""")
def scan_anchor_blocks(t):
    line = lambda x: F.when(x["l_returnflag"] == "R", "###").otherwise(F.concat(F.lit("a"), one(x, "l_partkey"), F.lit("\tb"), one(x, "l_suppkey"), F.when(x["l_returnflag"] == "A", F.concat(F.lit("\t"), one(x, "l_tax"))).otherwise("\tbad")))
    got = tx.scan_anchor_blocks(order_files(t, line))
    return got.withColumn("block", F.col("block").cast("long"))


@query("scan_collinearity", "SELECT gene, count(*) AS n FROM (SELECT 'g' || l_partkey gene FROM lineitem UNION ALL SELECT 's' || l_suppkey FROM lineitem) GROUP BY 1")
def scan_collinearity(t):
    row = F.concat(F.lit("  0- 1:\t").substr(F.lit(1), F.lit(0)), F.lit("b1 g"), s("l_partkey"), F.lit("\ts"), s("l_suppkey"), F.lit("  0.0"))
    return tx.scan_collinearity(t.lineitem.select(row.alias("value")).unionByName(t.region.select(F.lit("# header").alias("value"))))


@query("scan_tm_prediction", "SELECT 'd' || doc_id AS seq_id, (n_chars % 100) / 100 AS tm_confidence, (n_chars % 9)::INTEGER AS tm_count FROM documents WHERE doc_id % 4 > 0")
def scan_tm_prediction(t):
    n = F.when(F.col("doc_id") % 4 == 0, "?").when(F.col("doc_id") % 4 == 1, F.concat((F.col("n_chars") % 9).cast("string"), F.lit(".0"))).otherwise((F.col("n_chars") % 9).cast("string"))
    row = F.concat_ws("\t", F.concat(F.lit("d"), s("doc_id")), F.lit("TM"), ((F.col("n_chars") % 100) / 100).cast("string"), F.lit("0"), n)
    return tx.scan_tm_prediction(t.documents.select(row.alias("value")))


@query("scan_topology", "SELECT 'c' || c_custkey AS id, c_name AS seq, repeat('I', c_nationkey) || 'MMM' || repeat('O', 5) AS topology FROM customer")
def scan_topology(t):
    topo = F.concat(F.repeat(F.lit("I"), F.col("c_nationkey")), F.lit("MMMOOOOO"))
    return tx.scan_topology(t.customer.select(F.concat(F.lit(">c"), s("c_custkey"), F.lit(" | TM\n"), F.col("c_name"), F.lit("\n"), topo, F.lit("\n")).alias("value")))


@query("scan_branch_json", """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 3 ORDER BY l_linenumber, l_partkey, l_suppkey) r FROM lineitem WHERE l_linenumber > 0), f AS (SELECT * FROM l WHERE r = 1)
SELECT 'f' || l_orderkey AS path, 'b' || (l_partkey % 3) AS branch_id, round(l_quantity / 10 * 0.25 + l_tax * 10 * 0.75, 9) AS omega_mean, round(greatest(l_quantity / 10, l_tax * 10), 9) AS omega_max, CASE WHEN l_quantity / 10 >= l_tax * 10 THEN 0.25 ELSE 0.75 END AS weight_at_max, 2 AS n_rate_classes,
 round(CASE WHEN l_returnflag = 'A' THEN l_discount ELSE l_tax END, 9) AS corrected_p_value, (l_returnflag = 'A')::INTEGER AS is_already_corrected, (CASE WHEN l_returnflag = 'A' THEN l_discount ELSE l_tax END < 0.05 AND greatest(l_quantity / 10, l_tax * 10) > 1)::INTEGER AS is_selected FROM f""")
def scan_branch_json(t):
    def line(x):
        return F.concat(F.lit('"k'), one(x, "l_linenumber"), F.lit("_"), one(x, "l_partkey"), F.lit("_"), one(x, "l_suppkey"), F.lit('":{"original name":"b'), (x["l_partkey"] % 3).cast("string"), F.lit('","Rate Distributions":[['), (x["l_quantity"] / 10).cast("string"),
                        F.lit(",0.25],["), (x["l_tax"] * 10).cast("string"), F.lit(",0.75]],"), F.when(x["l_returnflag"] == "A", F.concat(F.lit('"Corrected P-value":'), one(x, "l_discount"), F.lit(","))).otherwise(""), F.lit('"Uncorrected P-value":'), one(x, "l_tax"), F.lit("}"))

    files = order_files(t, line, ",")
    wrap = F.when(F.length("path") % 2 == 0, F.concat(F.lit('{"branch attributes":{"0":{'), "value", F.lit("}}}"))).otherwise(F.concat(F.lit('{"branch attributes":{'), "value", F.lit("}}")))
    got = ns.scan_branch_json(files.select("path", wrap.alias("value")))
    return rounded(got.select("path", "branch_id", "omega_mean", "omega_max", "weight_at_max", "n_rate_classes", "corrected_p_value", "is_already_corrected", "is_selected"))


@query("scan_genewide_json", """
WITH x AS (SELECT *, l_linenumber % 4 n, list_sort([l_quantity, l_tax * 100, l_discount * 100][1:(l_linenumber % 4)::INT]) o FROM lineitem)
SELECT 'f' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS path, l_tax AS p_value, l_quantity AS lrt, round(CASE WHEN n > 0 THEN o[1] ELSE 'nan'::DOUBLE END, 9) AS omega_low, round(CASE WHEN n >= 3 THEN o[2] ELSE 'nan'::DOUBLE END, 9) AS omega_mid, round(CASE WHEN n > 0 THEN o[-1] ELSE 'nan'::DOUBLE END, 9) AS omega_high FROM x""")
def scan_genewide_json(t):
    n = F.col("l_linenumber") % 4
    cells = F.array(F.concat(F.lit("["), s("l_quantity"), F.lit(",0.5]")), F.concat(F.lit("["), (F.col("l_tax") * 100).cast("string"), F.lit(",0.3]")), F.concat(F.lit("["), (F.col("l_discount") * 100).cast("string"), F.lit(",0.2]")))
    rates = F.array_join(F.slice(cells, F.lit(1), n), ",")
    v = F.concat(F.lit('{"test results":{"p-value":'), s("l_tax"), F.lit(',"LRT":'), s("l_quantity"), F.lit('},"fits":{"Unconstrained model":{"Rate Distributions":{"Test":['), rates, F.lit("]}}}}"))
    path = F.concat(F.lit("f"), F.concat_ws("_", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey")))
    got = ns.scan_genewide_json(t.lineitem.select(path.alias("path"), v.alias("value")))
    return rounded(got.select("path", "p_value", "lrt", "omega_low", "omega_mid", "omega_high"))


@query("scan_site_json", """
SELECT 'f' || l_orderkey AS path, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)::INTEGER AS site, l_discount AS alpha, l_quantity AS beta_plus, l_tax AS p_value FROM lineitem""")
def scan_site_json(t):
    line = lambda x: F.concat(F.lit("["), one(x, "l_discount"), F.lit(",0.5,"), one(x, "l_quantity"), F.lit(",1,"), one(x, "l_tax"), F.lit("]"))
    f = order_files(t, line, ",")
    v = F.concat(F.lit('{"MLE":{"headers":[["alpha;","x"],["&beta;<sup>-</sup>","x"],["&beta;+","x"],["LRT","x"],["p-value","x"]],"content":{"0":['), "value", F.lit("]}}}"))
    return ns.scan_site_json(f.select("path", v.alias("value")))


@query("scan_placement_json", """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) r FROM lineitem), b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag = 'R', l_quantity DESC, r) k FROM l)
SELECT 'f' || l_orderkey AS path, 'q' || l_orderkey AS query, l_suppkey::INTEGER AS edge_num, CASE WHEN l_returnflag = 'R' THEN 'nan'::DOUBLE ELSE l_quantity / 50 END AS lwr FROM b WHERE k = 1 AND l_returnflag <> 'R'
UNION ALL SELECT 'f' || l_orderkey, 'q' || l_orderkey, l_suppkey::INTEGER, 'nan'::DOUBLE FROM l WHERE r = 1 AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')""")
def scan_placement_json(t):
    line = lambda x: F.concat(F.lit("["), one(x, "l_suppkey"), F.lit(",-1.0,"), F.when(x["l_returnflag"] == "R", "NaN").otherwise((x["l_quantity"] / 50).cast("string")), F.lit("]"))
    f = order_files(t, line, ",")
    name = F.concat(F.lit("q"), F.expr("substring(path, 2)"))
    who = F.when(F.length("path") % 2 == 0, F.concat(F.lit('"n":["'), name, F.lit('"]'))).otherwise(F.concat(F.lit('"nm":[["'), name, F.lit('","1"]]')))
    v = F.concat(F.lit('{"fields":["edge_num","likelihood","like_weight_ratio"],"placements":[{'), who, F.lit(',"p":['), "value", F.lit("]}]}"))
    return ns.scan_placement_json(f.select("path", v.alias("value")))


@query("scan_newick", """
SELECT 'f' || l_orderkey AS tree, 'L' || l_linenumber || '_' || l_partkey AS label, l_quantity AS length, 2 AS depth FROM lineitem""")
def scan_newick(t):
    line = lambda x: F.concat(F.lit("L"), one(x, "l_linenumber"), F.lit("_"), one(x, "l_partkey"), F.lit(":"), one(x, "l_quantity"))
    f = order_files(t, line, ",")
    trees = f.select(F.col("path").alias("tree"), F.concat(F.lit("(("), "value", F.lit(")88/97:0.5{3});")).alias("value"))
    e = ns.scan_newick(trees)
    depth = tr.root_paths(e.select("tree", "node", "parent", "length"))
    return e.where("label LIKE 'L%'").join(depth.select("tree", "node", "depth"), ["tree", "node"]).select("tree", "label", "length", "depth")


@query("scan_family_change", """
WITH f AS (SELECT o_orderkey og, o_totalprice / 600000 p FROM orders), c AS (SELECT l_orderkey og, 'b' || l_returnflag b, sum(l_quantity - 25)::BIGINT c, min(l_tax) q FROM lineitem GROUP BY 1, 2)
SELECT og, round(p, 9) AS family_p, b AS branch, c AS change, CASE WHEN b <> 'bR' THEN q END AS branch_p FROM f JOIN c USING (og) WHERE c <> 0""")
def scan_family_change(t):
    fam = t.orders.select(F.col("o_orderkey").alias("og"), (F.col("o_totalprice") / 600000).alias("family_p"))
    flag = t.lineitem.withColumn("b", F.concat(F.lit("b"), F.col("l_returnflag")))
    ch = flag.groupBy(F.col("l_orderkey").alias("og")).pivot("b", ["bA", "bN", "bR"]).agg(F.sum(F.col("l_quantity") - 25))
    pr = flag.groupBy(F.col("l_orderkey").alias("og")).pivot("b", ["bA", "bN"]).agg(F.min("l_tax"))
    return rounded(tx.scan_family_change(fam, ch, pr))


@query("scan_cluster_dump", """
SELECT 'f' || l_orderkey AS path, 'm' || l_partkey || '_' || l_linenumber AS member, l_linenumber = 1 AS is_rep, CASE WHEN l_linenumber > 1 THEN l_quantity END AS identity FROM lineitem""")
def scan_cluster_dump(t):
    def line(x):
        tail = F.when(x["l_linenumber"] == 1, "*").otherwise(F.concat(F.lit("at "), one(x, "l_quantity"), F.lit("%")))
        return F.concat(F.lit(">Cluster 0\n0\t300aa, >m"), one(x, "l_partkey"), F.lit("_"), one(x, "l_linenumber"), F.lit("... "), tail)

    return tx.scan_cluster_dump(order_files(t, line)).drop("cluster")


@query("scan_id_map", "SELECT 'c' || o_custkey AS id, CASE WHEN c_nationkey < 20 THEN c_nationkey::VARCHAR ELSE 'c' || o_custkey END AS taxid FROM (SELECT DISTINCT o_custkey, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey)")
def scan_id_map(t):
    m = t.customer.where("c_nationkey < 20").select(F.concat(F.lit("ref_"), s("c_custkey")).alias("short_id"), F.concat(F.lit("c"), s("c_custkey")).alias("original_id"), s("c_nationkey").alias("taxid"), F.lit("reference").alias("source_type"))
    ids = t.orders.select(F.concat(F.lit("c"), s("o_custkey")).alias("id")).distinct()
    return tx.resolve_ids(ids, tx.scan_id_map(m))


@query("scan_uniprot", """
SELECT p_partkey AS accession, CASE WHEN p_size % 3 = 0 THEN 'chemokine' WHEN p_size % 3 = 1 THEN 'nucleotide' ELSE '' END AS family, CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'UNKNOWN' END AS class FROM part""")
def scan_uniprot(t):
    rows = t.part.select(F.col("p_partkey").alias("accession"), F.when(F.col("p_size") % 3 == 0, "C-X-C chemokine receptor").otherwise(F.col("p_name")).alias("protein_name"),
                         F.when(F.col("p_size") % 3 == 1, "ADORA1").otherwise("").alias("gene_names"), F.lit("").alias("similarity"), F.when(F.col("p_size") % 2 == 0, "PF00001;").otherwise("").alias("pfam"))
    return tx.scan_uniprot(rows).select("accession", "family", "class")


@query("scan_evidence_json", """
SELECT 'P' || p_partkey AS accession, CASE WHEN p_size % 2 = 0 THEN 'Mollusca' ELSE '' END AS phylum, CASE WHEN p_size % 3 = 0 THEN 'ECO:0000256,ECO:0000269' ELSE 'ECO:0000256' END AS codes, CASE WHEN p_size % 5 = 0 THEN 'B' ELSE 'A' END AS class, CASE WHEN p_size % 5 = 0 THEN 'curated' ELSE 'domain' END AS class_basis FROM part""")
def scan_evidence_json(t):
    v = F.concat(F.lit('{"entryType":"UniProtKB reviewed (Swiss-Prot)","primaryAccession":"P'), s("p_partkey"), F.lit('","organism":{"lineage":["Eukaryota","Metazoa"'), F.when(F.col("p_size") % 2 == 0, ',"Mollusca"').otherwise(""),
                 F.lit(']},"comments":[{"texts":[{"evidences":[{"evidenceCode":"ECO:0000256"}],"value":"'), F.when(F.col("p_size") % 5 == 0, "Belongs to the G-protein coupled receptor 2 family.").otherwise("x"), F.lit('"}]}],"xrefs":[{"database":"Pfam","id":"PF00001"}],"features":['),
                 F.when(F.col("p_size") % 3 == 0, '{"evidences":[{"evidenceCode":"ECO:0000269"},{"evidenceCode":"ECO:0000269"}]}').otherwise(""), F.lit("]}"))
    got = ns.scan_evidence_json(t.part.select(v.alias("value")))
    return got.select("accession", "phylum", F.array_join("evidence_codes", ",").alias("codes"), "class", "class_basis")


@query("scan_assembly_jsonl", """
SELECT 'GC' || CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'A' END || '_' || p_partkey || '.1' AS accession, p_size::BIGINT AS taxid, p_name AS binomial, CASE WHEN p_size % 2 = 0 THEN 'RefSeq' ELSE 'GenBank' END AS source, 'Scaffold' AS level, p_size % 3 = 0 AS annotated,
 CASE WHEN p_size % 3 = 0 THEN p_partkey ELSE 0 END AS n_proteins, p_partkey * 10 AS n50, p_partkey * 100 AS length FROM part WHERE p_size % 7 > 0""")
def scan_assembly_jsonl(t):
    v = F.concat(F.lit('{"accession":"GC'), F.when(F.col("p_size") % 2 == 0, "F").otherwise("A"), F.lit("_"), s("p_partkey"), F.lit('.1","organism":{'), F.when(F.col("p_size") % 7 > 0, F.concat(F.lit('"tax_id":'), s("p_size"), F.lit(","))).otherwise(""), F.lit('"organism_name":"'), "p_name",
                 F.lit('"},"assembly_info":{"assembly_level":"Scaffold","release_date":"2024-01-01"},'), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"annotation_info":{"stats":{"gene_counts":{"protein_coding":'), s("p_partkey"), F.lit("}}},"))).otherwise(""),
                 F.lit('"assembly_stats":{"contig_n50":'), (F.col("p_partkey") * 10).cast("string"), F.lit(',"total_sequence_length":"'), (F.col("p_partkey") * 100).cast("string"), F.lit('"}}'))
    return ns.scan_assembly_jsonl(t.part.select(v.alias("value"))).drop("date")


@query("scan_structure_alignment", "SELECT 'f' || p_partkey AS path, p_size / 100 AS tm_score, CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'W' END AS toggle, CASE WHEN p_size % 3 > 0 THEN 'P' END AS anchor FROM part")
def scan_structure_alignment(t):
    v = F.concat(F.lit("# aligned\nTM-score\t"), (F.col("p_size") / 100).cast("string"), F.lit("\nref_resnum\tcand_resnum\tres\n265\t240\t"), F.when(F.col("p_size") % 2 == 0, "y").otherwise("W"), F.lit("\n267\t"), F.when(F.col("p_size") % 3 > 0, "242\tP").otherwise("-\t-"), F.lit("\nbroken row here now\n"))
    got = tx.scan_structure_alignment(t.part.select(F.concat(F.lit("f"), s("p_partkey")).alias("path"), v.alias("value")))
    return got.select("path", "tm_score", F.try_element_at("residues", F.lit(265)).alias("toggle"), F.try_element_at("residues", F.lit(267)).alias("anchor"))


@query("scan_hhr", "SELECT 'q' || l_orderkey AS query, 'h' || l_partkey AS hit, round(l_quantity, 1) AS prob, l_tax AS evalue FROM lineitem WHERE l_tax <= 0.05")
def scan_hhr(t):
    line = lambda x: F.concat(F.lit("  1 h"), one(x, "l_partkey"), F.lit(" some protein  "), one(x, "l_quantity"), F.lit(" "), one(x, "l_tax"), F.lit(" 1E-9  123.4  0.5  120  1-120  3-122 (300)"))
    f = order_files(t, line)
    head = F.concat(F.lit("Query         q"), F.expr("substring(path, 2)"), F.lit(" x\n\n No Hit Prob E-value\n"), "value")
    return tx.scan_hhr(f.select("path", head.alias("value")), 0.05).select("query", "hit", F.round("prob", 1).alias("prob"), "evalue")


@query("scan_bakeoff_log", "SELECT 'm' || l_orderkey AS model, 's' || l_linenumber AS score, l_tax::VARCHAR AS auroc FROM lineitem")
def scan_bakeoff_log(t):
    line = lambda x: F.concat(F.lit("  s"), one(x, "l_linenumber"), F.lit(" auroc="), one(x, "l_tax"))
    f = order_files(t, line)
    v = F.concat(F.lit("=== m"), F.expr("substring(path, 2)"), F.lit(" ===\n"), "value", F.lit("\n"))
    return tx.scan_log_blocks(f.select(v.alias("value")), r"=== (\S+) ===\n(?:  .*\n)+", r"  (s\d+) auroc=(\S+)", ["model"], ["score", "auroc"])


@query("scan_records_dir", "SELECT c_nationkey::BIGINT AS taxid, 'Genus n' || c_nationkey AS name, count(*) AS n_input, count(*) FILTER (c_acctbal > 0) AS n_positive, count(*) FILTER (c_acctbal > 5000) AS n_passed FROM customer GROUP BY 1, 2")
def scan_records_dir(t):
    path = F.concat(F.lit("/scan/"), s("c_nationkey"), F.lit("_Genus_n"), s("c_nationkey"), F.lit(".tsv"))
    row = F.concat_ws("\t", s("c_custkey"), F.when(F.col("c_acctbal") > 0, "True").otherwise("False"), F.lit("7"), F.lit("0.9"), F.when(F.col("c_acctbal") > 5000, "yes").otherwise("no"))
    head = t.customer.select(path.alias("path"), F.lit("seq_id\tgpcr_positive\ttm_count\ttm_confidence\tpassed_gate").alias("value")).distinct()
    return tx.scan_records_dir(t.customer.select(path.alias("path"), row.alias("value")).unionByName(head))


@query("scan_embeddings", "SELECT vec_id AS id, len(embedding)::INTEGER AS width, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings")
def scan_embeddings(t):
    got = ns.scan_embeddings(t.embeddings, "vec_id", "embedding")
    return got.select("id", "width", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("scan_asr_state", "SELECT 'Node7' AS node, string_agg(substr(c_mktsegment, 1, 1), '' ORDER BY c_custkey) AS seq FROM customer WHERE c_nationkey = 7")
def scan_asr_state(t):
    row = F.concat_ws("\t", F.concat(F.lit("Node"), s("c_nationkey")), s("c_custkey"), F.substring("c_mktsegment", 1, 1), F.lit("0.99"))
    lines = t.customer.select(row.alias("value")).unionByName(t.region.select(F.lit("# comment").alias("value"))).unionByName(t.region.select(F.lit("Node\tSite\tState").alias("value")))
    return tx.scan_asr_state(lines, "Node7")


@query("sink_atomic_table", "SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'new' ELSE 'old' END AS state, p_brand FROM part")
def sink_atomic_table(t):
    path = f"{shared_dir(t.spark)}/table-{uuid.uuid4().hex}"
    rows = t.part.select("p_partkey", F.lit("old").alias("state"), "p_brand")
    sk.publish_table(rows, path, "p_brand")
    sk.publish_table(rows.where("p_brand IN ('Brand#1', 'Brand#2')").withColumn("state", F.lit("new")), path, "p_brand")
    return t.spark.read.parquet(path).select("p_partkey", "state", "p_brand")


@query("sink_fasta", "SELECT 'p' || p_partkey AS id, p_name AS seq, p_type FROM part".replace("p_name", "replace(p_name, ' ', '')"))
def sink_fasta(t):
    path = f"{shared_dir(t.spark)}/groups-{uuid.uuid4().hex}"
    sk.write_fasta(t.part.select(F.concat(F.lit("p"), s("p_partkey")).alias("id"), F.col("p_name").alias("seq"), "p_type"), path, "p_type")
    rows = t.spark.read.text(path, lineSep="\n>")
    return tx.scan_fasta(rows).select("id", "seq", "p_type")


@query("sink_channel_tsv", "SELECT c_custkey::VARCHAR AS id, c_mktsegment AS struct_state, NULL::VARCHAR AS struct_novelty FROM customer")
def sink_channel_tsv(t):
    path = f"{shared_dir(t.spark)}/channel-{uuid.uuid4().hex}"
    sk.write_channel(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("struct_state")), path, ["id", "struct_state", "struct_novelty"])
    return t.spark.read.option("sep", "\t").option("header", True).csv(path)
