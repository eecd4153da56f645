"""Intervals and runs over events, order lines and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidara.operators import intervals as iv
from evidara.plans.registry import query
from evidara.plans.stats import rounded
from evidara.session import cut

EV_SQL = """ev AS (SELECT event_id id, event_type chrom, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END strand, user_id,
 floor(epoch(ts))::BIGINT s, floor(epoch(ts))::BIGINT + 1 + floor(value * 8)::BIGINT e, value FROM events)"""


def placed_events(t):
    start = F.unix_timestamp("ts")
    return t.events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("chrom"),
        F.when(F.col("user_id") % 2 == 0, "+").otherwise("-").alias("strand"), "user_id",
        start.alias("start"), (start + 1 + F.floor(F.col("value") * 8)).alias("end"), "value")


LOCI_SQL = EV_SQL + """, o AS (SELECT *, max(e) OVER (PARTITION BY chrom, strand ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM ev),
loci AS (SELECT *, sum((reach IS NULL OR s >= reach)::INT) OVER (PARTITION BY chrom, strand ORDER BY s, e, id ROWS UNBOUNDED PRECEDING)::BIGINT locus FROM o)"""


@query("interval_loci", f"WITH {LOCI_SQL} SELECT id, chrom, strand, locus FROM loci")
def interval_loci(t):
    return iv.interval_loci(placed_events(t), ["chrom", "strand"], "id").select("id", "chrom", "strand", "locus")


@query("tandem_clusters", f"""
WITH {EV_SQL}, o AS (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY s, id) pe FROM ev),
c AS (SELECT *, sum((pe IS NULL OR s - pe > 9000)::INT) OVER (PARTITION BY user_id ORDER BY s, id ROWS UNBOUNDED PRECEDING) ch FROM o),
z AS (SELECT user_id, ch, count(*) n FROM c GROUP BY 1, 2 HAVING count(*) >= 3), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ch) k FROM z)
SELECT id, coalesce(n, 1) AS size, CASE WHEN n IS NOT NULL THEN c.user_id || ':cluster_' || k END AS cluster FROM c LEFT JOIN k USING (user_id, ch)""")
def tandem_clusters(t):
    return iv.tandem_clusters(placed_events(t), "user_id", "id", 9000, 3)


@query("interval_overlap_join", f"""
WITH {EV_SQL}, g AS (SELECT DISTINCT chrom, strand, s, e FROM ev WHERE value > 100)
SELECT m.id, count(g.s) AS n_overlaps FROM (SELECT * FROM ev WHERE value <= 100) m
LEFT JOIN g ON g.chrom = m.chrom AND g.strand = m.strand AND m.s < g.e AND g.s < m.e GROUP BY m.id""")
def interval_overlap_join(t):
    ev = cut(placed_events(t))
    return iv.overlap_counts(ev.where("value <= 100"), ev.where("value > 100"), ["chrom", "strand"], "id")


MODELS_SQL = EV_SQL + """, md AS (SELECT id query, chrom, strand, s, e, CASE WHEN user_id % 3 = 0 THEN 'genome' ELSE 'txome' END source, id % 4 <> 0 complete,
 floor(value)::BIGINT len, value % 5 margin, user_id % 11 = 0 mm FROM ev)"""


def models(t):
    ev = placed_events(t)
    return ev.select(
        F.col("id").alias("query"), "chrom", "strand", "start", "end", F.when(F.col("user_id") % 3 == 0, "genome").otherwise("txome").alias("source"),
        (F.col("id") % 4 != 0).alias("complete"), F.floor("value").alias("length"), (F.col("value") % 5).alias("margin"),
        (F.col("user_id") % 11 == 0).alias("multi_mapping"))


REP_SQL = MODELS_SQL + """, lo AS (SELECT *, max(e) OVER (PARTITION BY chrom, strand ORDER BY s, e, query ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM md),
ll AS (SELECT *, sum((reach IS NULL OR s >= reach)::INT) OVER (PARTITION BY chrom, strand ORDER BY s, e, query ROWS UNBOUNDED PRECEDING)::BIGINT locus FROM lo),
gn AS (SELECT DISTINCT chrom, strand, s, e FROM ev WHERE value > 200),
ov AS (SELECT query, count(*) k FROM ll JOIN gn USING (chrom, strand) WHERE ll.s < gn.e AND gn.s < ll.e GROUP BY 1),
rk AS (SELECT ll.*, coalesce(k, 0) k, row_number() OVER (PARTITION BY chrom, strand, locus ORDER BY complete DESC, len DESC, source <> 'genome', query) r,
 row_number() OVER (PARTITION BY chrom, strand, locus, source ORDER BY complete DESC, len DESC, query) rs FROM ll LEFT JOIN ov USING (query)),
gg AS (SELECT chrom, strand, locus, min(s) AS start, max(e) AS "end", count(*) n_members, max(query) FILTER (r = 1) representative, max(margin) FILTER (r = 1) margin, bool_or(mm) FILTER (r = 1) mm,
 max(len) FILTER (rs = 1 AND source = 'genome') gl, max(len) FILTER (rs = 1 AND source = 'txome') tl, bool_or(complete) ac, max(k) mg FROM rk GROUP BY 1, 2, 3)"""


@query("representative_pick", f"WITH {REP_SQL} SELECT chrom, strand, locus, start, \"end\", n_members, representative FROM gg")
def representative_pick(t):
    got = iv.reconcile_genes(models(t))
    return got.select("chrom", "strand", "locus", "start", "end", "n_members", "representative")


@query("locus_provenance", f"""
WITH {REP_SQL} SELECT chrom, strand, locus, CASE WHEN gl IS NOT NULL AND tl IS NOT NULL THEN 'both' WHEN gl IS NOT NULL THEN 'genome_only' ELSE 'transcriptome_only' END AS provenance,
 concat_ws(',', CASE WHEN mg >= 2 THEN 'chimeric' END, CASE WHEN margin < 2 THEN 'low_margin' END, CASE WHEN mm THEN 'multi_mapping' END, CASE WHEN NOT ac THEN 'partial_only' END,
 CASE WHEN greatest(gl, tl) > 0 AND gl IS NOT NULL AND tl IS NOT NULL AND abs(gl - tl) / greatest(gl, tl) > 0.2 THEN 'source_disagreement' END) AS qc_flags FROM gg""")
def locus_provenance(t):
    genes = placed_events(t).where("value > 200").select("chrom", "strand", "start", "end")
    return iv.reconcile_genes(models(t), genes).select("chrom", "strand", "locus", "provenance", "qc_flags")


def placements(t, mod, methods=4):
    """The lines of one of so many methods, by line number."""
    s = F.col("l_partkey") % 500 * 100
    return t.lineitem.where(F.col("l_linenumber") % methods == mod).select(
        F.col("l_orderkey").alias("query"), F.col("l_returnflag").alias("chrom"), s.alias("start"),
        (s + F.col("l_quantity").cast("long") * 200 + 1).alias("end"), F.col("l_linestatus").alias("strand"),
        F.round(90 + F.col("l_discount") * 100, 2).alias("identity"), (F.col("l_quantity") * 2).alias("coverage"),
        F.lit(f"m{mod}").alias("method"))


PL_SQL = """pm AS (SELECT l_orderkey query, l_returnflag chrom, l_partkey % 500 * 100 s, l_partkey % 500 * 100 + l_quantity::BIGINT * 200 + 1 e, l_linestatus strand,
 round(90 + l_discount * 100, 2) ident, l_quantity * 2 cov, 'm' || (l_linenumber % 4) m FROM lineitem),
conc AS (SELECT DISTINCT a.* FROM (SELECT * FROM pm WHERE m = 'm0' AND ident >= 92 AND cov >= 20) a JOIN (SELECT * FROM pm WHERE m = 'm1' AND ident >= 92 AND cov >= 20) b
  ON a.query = b.query AND a.chrom = b.chrom AND a.strand = b.strand AND a.s < b.e AND b.s < a.e AND a.ident >= b.ident
 UNION SELECT b.* FROM (SELECT * FROM pm WHERE m = 'm0' AND ident >= 92 AND cov >= 20) a JOIN (SELECT * FROM pm WHERE m = 'm1' AND ident >= 92 AND cov >= 20) b
  ON a.query = b.query AND a.chrom = b.chrom AND a.strand = b.strand AND a.s < b.e AND b.s < a.e AND b.ident > a.ident)"""


def methods_sql(sql, methods):
    return sql.replace("l_linenumber % 4", f"l_linenumber % {methods}")


@query("concordant_placement", f'WITH {methods_sql(PL_SQL, 2)} SELECT query, chrom, s AS start, e AS "end", strand, ident AS identity, cov AS coverage, m AS method FROM conc')
def concordant_placement(t):
    """Even lines are placed by one method, odd lines by the other."""
    got = iv.concordant_placements(placements(t, 0, 2), placements(t, 1, 2), 92, 20, 2000)
    return got.select("query", "chrom", "start", "end", "strand", "identity", "coverage", "method")


CASCADE_SQL = PL_SQL + """, st AS (SELECT 0 step, * FROM conc UNION ALL SELECT 1, * FROM pm WHERE m = 'm2' AND ident >= 92 AND cov >= 20 UNION ALL SELECT 2, * FROM pm WHERE m = 'm3' AND ident >= 92 AND cov >= 20),
o AS (SELECT *, max(e) OVER (PARTITION BY step, query, chrom, strand ORDER BY s, e, ident, cov, m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM st),
l AS (SELECT *, sum((reach IS NULL OR s >= reach)::INT) OVER (PARTITION BY step, query, chrom, strand ORDER BY s, e, ident, cov, m ROWS UNBOUNDED PRECEDING) locus FROM o),
rp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY step, query, chrom, strand, locus ORDER BY ident DESC, chrom, s, e, strand, m) r FROM l) WHERE r = 1),
bm AS (SELECT *, row_number() OVER (PARTITION BY step, query ORDER BY ident DESC, chrom, s, e, strand, m) k, lead(ident) OVER (PARTITION BY step, query ORDER BY ident DESC, chrom, s, e, strand, m) nx,
 count(*) OVER (PARTITION BY step, query) n_loci FROM rp)"""


@query("best_and_margin", f"""
WITH {methods_sql(CASCADE_SQL.replace("SELECT 0 step, * FROM conc", "SELECT 0 step, * FROM pm WHERE ident >= 92 AND cov >= 20"), 1)} SELECT query, chrom, s AS start, e AS "end", strand, ident AS identity, coalesce(round(ident - nx, 4), 'inf'::DOUBLE) AS margin, n_loci FROM bm WHERE step = 0 AND k = 1""")
def best_and_margin(t):
    rows = placements(t, 0, 1).where("identity >= 92 AND coverage >= 20")
    got = iv.best_and_margin(rows)
    return got.select("query", "chrom", "start", "end", "strand", "identity", F.round("margin", 4).alias("margin"), "n_loci")


@query("placement_cascade", f"""
WITH {CASCADE_SQL}, ok AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY step) f FROM bm WHERE k = 1 AND (n_loci = 1 OR round(ident - nx, 6) >= 2))
SELECT o_orderkey AS query, chrom, s AS start, e AS "end", strand, ident AS identity, cov AS coverage,
 CASE step WHEN 0 THEN 'minimap2+gmap_concordant' WHEN 1 THEN 'miniprot' WHEN 2 THEN 'rbh' ELSE 'unplaced' END AS method,
 CASE step WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'none' END AS confidence, coalesce(n_loci >= 2, false) AS multi_mapping
FROM orders LEFT JOIN ok ON o_orderkey = query AND f = 1""")
def placement_cascade(t):
    q = t.orders.select(F.col("o_orderkey").alias("query"))
    got = iv.placement_cascade(q, placements(t, 0), placements(t, 1), placements(t, 2), placements(t, 3), 92, 20, 1.999999, 2000)
    return got.drop("margin")


@query("greedy_locus_claim")
def greedy_locus_claim(t):
    ev = placed_events(t).select("id", "chrom", "start", "end", "value")
    return iv.greedy_locus_claim(ev, "chrom", "id", "value", 0.2, 3000)


@query("topology_runs", """
WITH c AS (SELECT doc_id, i, upper(ch) ch, n FROM (SELECT doc_id, length(text) n, unnest(regexp_extract_all(text, '(?s).')) ch, unnest(range(1, length(text) + 1)) i FROM documents)),
k AS (SELECT doc_id, i, n, ch, lag(ch) OVER (PARTITION BY doc_id ORDER BY i) p FROM c WHERE ch IN ('M', 'O', 'I')),
s AS (SELECT doc_id, i, n, ch, lead(i) OVER (PARTITION BY doc_id ORDER BY i) nx FROM k WHERE p IS NULL OR p <> ch),
r AS (SELECT doc_id, CASE ch WHEN 'M' THEN 'tm' WHEN 'O' THEN 'ecl' ELSE 'icl' END kind, i a, coalesce(nx - 1, n) b FROM s)
SELECT doc_id, kind, count(*) AS n_runs, sum(b - a + 1)::BIGINT AS residues, sum(a)::BIGINT AS starts FROM r GROUP BY 1, 2""")
def topology_runs(t):
    runs = iv.topology_runs(t.documents, "doc_id", "text")
    return runs.groupBy("doc_id", "kind").agg(F.count("*").alias("n_runs"), F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("residues"),
                                              F.sum("start").cast("long").alias("starts"))


KD_SQL = "CASE ch " + " ".join(f"WHEN '{k}' THEN {int(round(v * 10))}" for k, v in iv.HYDROPATHY.items()) + " ELSE 0 END"


@query("hydropathy_segments", f"""
WITH c AS (SELECT doc_id, i, {KD_SQL} v FROM (SELECT doc_id, i, upper(ch) ch FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?s).')) ch, unnest(range(1, length(text) + 1)) i FROM documents))),
w AS (SELECT doc_id, i - 1 p, sum(v) OVER r s, count(*) OVER r n FROM c WINDOW r AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 20 FOLLOWING)),
h AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) q FROM w WHERE n = 21 AND s >= 1.0 * 21 * 10),
g AS (SELECT doc_id, p, sum((q IS NULL OR p - q >= 29)::INT) OVER (PARTITION BY doc_id ORDER BY p) k FROM h)
SELECT doc_id, min(p) AS start, max(p) + 21 AS "end" FROM g GROUP BY doc_id, k""")
def hydropathy_segments(t):
    return iv.hydropathy_segments(t.documents, "doc_id", "text", threshold=1.0)


TRACK_SQL = """tr AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) pos, round(least(value, 100) / 100, 4) v FROM events)"""


def track(t):
    from evidara.ordering import row_numbers

    got = row_numbers(t.events.select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"], "pos")
    return cut(got.select("user_id", "pos", F.round(F.least("value", F.lit(100.0)) / 100, 4).alias("v")))


@query("sliding_mean", f"""
WITH {TRACK_SQL}, w AS (SELECT user_id, pos, avg(v) OVER r m, count(*) OVER r n FROM tr WINDOW r AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))
SELECT user_id, pos, round(m, 6) AS mean FROM w WHERE n = 10""")
def sliding_mean(t):
    return rounded(iv.sliding_mean(track(t), ["user_id"], "pos", "v", 10, block=16), 6)


@query("conserved_regions", f"""
WITH {TRACK_SQL}, w AS (SELECT user_id, pos, avg(v) OVER r m, count(*) OVER r n FROM tr WINDOW r AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
k AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) g FROM w WHERE n = 10 AND round(m, 9) >= 0.5),
z AS (SELECT user_id, max(pos) n FROM tr GROUP BY 1), s AS (SELECT user_id, min(pos) a, max(pos) b, n FROM k JOIN z USING (user_id) GROUP BY user_id, g, n),
r AS (SELECT user_id, a, CASE WHEN b = n - 9 THEN n ELSE b + 9 END e FROM s)
SELECT r.user_id, a AS start, e AS "end", e - a + 1 AS length, round(avg(v), 9) AS mean FROM r JOIN tr ON tr.user_id = r.user_id AND pos BETWEEN a AND e GROUP BY 1, 2, 3""")
def conserved_regions(t):
    return rounded(iv.conserved_regions(track(t), ["user_id"], "pos", "v", 10, 0.5), 9)


def alignment_columns(t):
    """Every nation is an alignment of its customers' names; the lenient one keeps all
    columns, the strict one a part of them."""
    rows = t.customer.select(F.col("c_nationkey").alias("og"), "c_custkey", F.posexplode(F.split("c_name", "")).alias("i", "ch"))
    cols = rows.groupBy("og", "i").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "ch"))), lambda x: x["ch"]), "")).alias("content"))
    return cut(cols)


@query("site_concordance", """
WITH RECURSIVE c AS (SELECT c_nationkey og, i - 1 i, md5(string_agg(substr(c_name, i::INT, 1), '' ORDER BY c_custkey)) h FROM customer, generate_series(1, 18) g(i) GROUP BY 1, 2),
l AS (SELECT og, i + 1 site, h FROM c), s AS (SELECT og, row_number() OVER (PARTITION BY og ORDER BY i) site, h FROM c WHERE i % 5 <> 2),
m AS (SELECT og, 0::BIGINT site, 0::BIGINT ls FROM (SELECT DISTINCT og FROM s) UNION ALL
 SELECT og, site, ls FROM (SELECT m.og, s.site, l.site ls, row_number() OVER (PARTITION BY m.og ORDER BY l.site) k FROM m JOIN s ON s.og = m.og AND s.site = m.site + 1 JOIN l ON l.og = s.og AND l.h = s.h AND l.site > m.ls) WHERE k = 1),
sp AS (SELECT s.og, s.site, ls FROM s LEFT JOIN m USING (og, site) WHERE s.site % 2 = 0), lp AS (SELECT og, site FROM l WHERE site % 3 = 0),
j AS (SELECT coalesce(sp.og, lp.og) og, sp.site a, lp.site b FROM sp FULL JOIN lp ON sp.og = lp.og AND sp.ls = lp.site)
SELECT og, count(a) AS n_strict_positive_sites, count(b) AS n_lenient_positive_sites, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS high_confidence_sites_n, count(*) FILTER (a IS NULL) AS lenient_only_sites_n,
 count(*) FILTER (b IS NULL) AS strict_only_sites_n, round(count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) / count(b), 6) AS alignment_robustness_index FROM j GROUP BY 1""")
def site_concordance(t):
    cols = alignment_columns(t)
    from evidara.ordering import row_numbers

    lenient = cols.select("og", F.lit("lenient").alias("kind"), (F.col("i") + 1).cast("long").alias("site"), "content")
    strict = row_numbers(cols.where("i % 5 <> 2"), ["og"], ["i"], "site").select("og", F.lit("strict").alias("kind"), "site", "content")
    mapping = cut(iv.map_columns(lenient.unionByName(strict), "og"))
    s = mapping.where("strict_site % 2 = 0").select("og", F.col("strict_site").alias("site"))
    l = lenient.where("site % 3 = 0").select("og", "site")
    return iv.site_concordance(mapping, s, l, "og")
