"""The tables as trees: region - nation - customer - order, and segment - customer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from evidara.operators import trees as tr
from evidara.plans.registry import query
from evidara.plans.stats import rounded
from evidara.session import cut


def _edges(tree, rows):
    return reduce(lambda a, b: a.unionByName(b), [
        df.select(F.lit(tree).alias("tree"), n.alias("node"), p.cast("string").alias("parent"), ln.cast("double").alias("length"), s.cast("double").alias("support"))
        for df, n, p, ln, s in rows])


def _name(prefix, col):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def world(t, with_orders=True):
    """Root, regions, nations, customers and (as leaves) their orders; inner nodes carry
    a support value, some of them none."""
    none = F.lit(None)
    one = t.region.where("r_regionkey = 0")
    rows = [
        (one, F.lit("root"), none, F.lit(0.0), none),
        (t.region, _name("r", "r_regionkey"), F.lit("root"), F.lit(0.5), F.col("r_regionkey") * 20 + 15),
        (t.nation, _name("n", "n_nationkey"), _name("r", "n_regionkey"), (F.col("n_nationkey") % 5 + 1) * 0.25, F.when(F.col("n_nationkey") % 3 > 0, F.col("n_nationkey") * 4)),
        (t.customer, _name("c", "c_custkey"), _name("n", "c_nationkey"), F.abs("c_acctbal") / 10000 + 0.01, F.when(F.col("c_custkey") % 4 > 0, F.col("c_custkey") % 100)),
    ]
    if with_orders:
        rows.append((t.orders, _name("o", "o_orderkey"), _name("c", "o_custkey"), F.col("o_totalprice") / 100000, none))
    else:
        rows[3] = (*rows[3][:4], none)
    return cut(_edges("world", rows))


WORLD_SQL = """e AS (SELECT 'root' node, NULL::VARCHAR parent, 0.0::DOUBLE len, NULL::DOUBLE sup UNION ALL SELECT 'r' || r_regionkey, 'root', 0.5, r_regionkey * 20 + 15 FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, (n_nationkey % 5 + 1) * 0.25, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey * 4 END FROM nation
 UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, abs(c_acctbal) / 10000 + 0.01, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 100 END FROM customer
 UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_totalprice / 100000, NULL FROM orders),
cl AS (SELECT node leaf, node anc, 0.0::DOUBLE dist, 0 steps FROM e UNION ALL SELECT cl.leaf, e.parent, cl.dist + e.len, cl.steps + 1 FROM cl JOIN e ON e.node = cl.anc WHERE e.parent IS NOT NULL)"""
LEAF_SQL = ", lf AS (SELECT node FROM e WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL))"


def order_nodes(t, cond):
    return t.orders.where(cond).select(F.lit("world").alias("tree"), _name("o", "o_orderkey").alias("node"))


@query("tree_closure", f"WITH RECURSIVE {WORLD_SQL} SELECT leaf AS node, round(max(dist), 9) AS dist, max(steps) AS depth FROM cl GROUP BY 1")
def tree_closure(t):
    return rounded(tr.root_paths(world(t))).select("node", "dist", "depth")


@query("tree_ancestors", f"WITH RECURSIVE {WORLD_SQL} SELECT leaf, anc, round(dist, 9) AS dist, steps FROM cl WHERE leaf LIKE 'o%'")
def tree_ancestors(t):
    return rounded(tr.closure(world(t), order_nodes(t, "true"))).drop("tree")


# finished orders are the references, all others ask
Q, R = "o_orderstatus <> 'F'", "o_orderstatus = 'F'"
REF_SQL = WORLD_SQL + """, rf AS (SELECT 'o' || o_orderkey node FROM orders WHERE o_orderstatus = 'F'), qr AS (SELECT 'o' || o_orderkey node FROM orders WHERE o_orderstatus <> 'F')"""


def near_sql(order):
    """References near each asking leaf: the five best below each of its ancestors hold its own five best."""
    return REF_SQL + f""", r5 AS (SELECT * FROM (SELECT cl.*, row_number() OVER (PARTITION BY anc ORDER BY {order}, leaf) k FROM cl JOIN rf ON rf.node = cl.leaf) WHERE k <= 5),
pr AS (SELECT q.leaf, r.leaf ref, q.dist + r.dist d, q.steps + r.steps s, q.anc lca, row_number() OVER (PARTITION BY q.leaf, r.leaf ORDER BY q.steps) k
 FROM cl q JOIN qr ON qr.node = q.leaf JOIN r5 r ON r.anc = q.anc), lca AS (SELECT * FROM pr WHERE k = 1)"""


NEAR_SQL = near_sql("dist")


@query("nearest_ref_distance", f"WITH RECURSIVE {NEAR_SQL} SELECT leaf, round(min(d), 9) AS dist FROM lca GROUP BY 1")
def nearest_ref_distance(t):
    return rounded(tr.nearest_refs(world(t), order_nodes(t, Q), order_nodes(t, R), 1)).select("leaf", "dist")


@query("landmark_nearest", f"""
WITH RECURSIVE {near_sql("steps")}, k AS (SELECT leaf, ref, s, row_number() OVER (PARTITION BY leaf ORDER BY s, ref) rn FROM lca) SELECT leaf, ref, s AS dist FROM k WHERE rn = 1""")
def landmark_nearest(t):
    return tr.nearest_refs(world(t), order_nodes(t, Q), order_nodes(t, R), 1, by="steps").select("leaf", "ref", "dist")


SUP_SQL = NEAR_SQL + """, kn AS (SELECT *, row_number() OVER (PARTITION BY leaf ORDER BY d, ref) rn FROM lca),
pth AS (SELECT k.leaf, k.ref, k.d, a.anc node FROM kn k JOIN cl a ON a.leaf = k.leaf JOIN cl l ON l.leaf = a.anc AND l.anc = k.lca WHERE rn <= 5 AND a.steps > 0
 UNION SELECT k.leaf, k.ref, k.d, a.anc FROM kn k JOIN cl a ON a.leaf = k.ref JOIN cl l ON l.leaf = a.anc AND l.anc = k.lca WHERE rn <= 5 AND a.steps > 0),
cf AS (SELECT leaf, ref, d, count(sup) nm, count(*) FILTER (sup >= 70) ns FROM pth JOIN e USING (node) GROUP BY 1, 2, 3)"""


@query("weighted_ref_proximity", f"""
WITH RECURSIVE {SUP_SQL} SELECT leaf, round(sum(CASE WHEN nm > 0 THEN ns / nm ELSE 1 END * CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END / (d + 1e-6)), 6) AS score FROM cf JOIN orders ON ref = 'o' || o_orderkey GROUP BY 1""")
def weighted_ref_proximity(t):
    w = t.orders.select(_name("o", "o_orderkey").alias("ref"), F.when(F.col("o_orderpriority") == "1-URGENT", 2.0).otherwise(1.0).alias("weight"))
    return rounded(tr.weighted_ref_proximity(world(t), order_nodes(t, Q), order_nodes(t, R), w, 5), 6).drop("tree")


@query("og_confidence", f"""
WITH RECURSIVE {SUP_SQL}, b AS (SELECT leaf, ref FROM kn WHERE rn = 1) SELECT leaf, CASE WHEN nm > 0 THEN round(ns / nm, 9) END AS confidence FROM cf JOIN b USING (leaf, ref)""")
def og_confidence(t):
    return rounded(tr.og_confidence(world(t), order_nodes(t, Q), order_nodes(t, R))).drop("tree")


def order_labels(t):
    return t.orders.select(F.lit("world").alias("tree"), _name("o", "o_orderkey").alias("node"), F.col("o_orderpriority").alias("family"))


@query("edge_family_map", f"""
WITH RECURSIVE {WORLD_SQL}, l AS (SELECT 'o' || o_orderkey leaf, o_orderpriority f FROM orders) SELECT anc AS node, min(f) AS family, count(*) AS n_leaves FROM cl JOIN l USING (leaf) GROUP BY 1 HAVING min(f) = max(f)""")
def edge_family_map(t):
    return tr.edge_family_map(world(t), order_labels(t)).drop("tree")


@query("monophyly_check", f"""
WITH RECURSIVE {WORLD_SQL}{LEAF_SQL}, l AS (SELECT 'o' || o_orderkey leaf, 'x' || o_custkey f FROM orders WHERE o_orderstatus <> 'P'), z AS (SELECT anc, count(*) n FROM cl JOIN lf ON lf.node = leaf GROUP BY 1),
k AS (SELECT anc, f, count(*) k FROM cl JOIN l USING (leaf) GROUP BY 1, 2), t AS (SELECT f, count(*) n FROM l GROUP BY 1), h AS (SELECT DISTINCT k.f FROM k JOIN z USING (anc) JOIN t ON t.f = k.f WHERE k.k = t.n AND z.n = t.n)
SELECT t.f AS family, t.n, CASE WHEN t.n >= 2 THEN h.f IS NOT NULL END AS monophyletic FROM t LEFT JOIN h USING (f)""")
def monophyly_check(t):
    lab = t.orders.where("o_orderstatus <> 'P'").select(F.lit("world").alias("tree"), _name("o", "o_orderkey").alias("node"), _name("x", "o_custkey").alias("family"))
    return tr.monophyly_check(world(t), lab).drop("tree")


@query("duplication_check", f"""
WITH RECURSIVE {WORLD_SQL}, l AS (SELECT 'o' || o_orderkey leaf, o_totalprice::BIGINT % 97 tx FROM (SELECT o_orderkey, floor(o_totalprice) o_totalprice FROM orders)),
k AS (SELECT DISTINCT parent, anc, tx FROM cl JOIN l USING (leaf) JOIN e ON e.node = anc WHERE parent IS NOT NULL), s AS (SELECT parent, tx FROM k GROUP BY 1, 2 HAVING count(*) > 1) SELECT parent AS node, count(*) AS n_shared FROM s GROUP BY 1""")
def duplication_check(t):
    tx = t.orders.select(F.lit("world").alias("tree"), _name("o", "o_orderkey").alias("node"), (F.floor("o_totalprice") % 97).alias("taxon"))
    return tr.duplications(world(t), tx).drop("tree")


def regrouped(t):
    """The same nations under three other groups; one segment of customers is missing."""
    none = F.lit(None)
    k = F.col("n_nationkey") % 3
    groups = t.nation.select(k.alias("k")).distinct()
    return cut(_edges("regrouped", [
        (t.region.where("r_regionkey = 0"), F.lit("root"), none, F.lit(0.0), none),
        (groups, _name("g", "k"), F.lit("root"), F.lit(0.3), F.lit(90)),
        (t.nation.withColumn("k", k), _name("n", "n_nationkey"), _name("g", "k"), F.lit(0.2), F.lit(60)),
        (t.customer.where("c_mktsegment <> 'MACHINERY'"), _name("c", "c_custkey"), _name("n", "c_nationkey"), F.lit(0.1), none)]))


@query("bipartition_distance", """
WITH l AS (SELECT c_custkey k, n_nationkey n, n_regionkey r, n_nationkey % 3 g FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'MACHINERY'), z AS (SELECT count(*) t FROM l),
s AS (SELECT 'a' tree, 'r' || r node, k FROM l UNION ALL SELECT 'a', 'n' || n, k FROM l UNION ALL SELECT 'b', 'g' || g, k FROM l UNION ALL SELECT 'b', 'n' || n, k FROM l),
i AS (SELECT tree, node, string_agg(k, ',' ORDER BY k) i, count(*) c FROM s GROUP BY 1, 2), o AS (SELECT i.tree, i.node, string_agg(l.k, ',' ORDER BY l.k) o FROM i, l WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.tree = i.tree AND s.node = i.node AND s.k = l.k) GROUP BY 1, 2),
p AS (SELECT DISTINCT tree, least(i, o) ky FROM i JOIN o USING (tree, node), z WHERE c BETWEEN 2 AND t - 2), q AS (SELECT count(*) FILTER (tree = 'a') a, count(*) FILTER (tree = 'b') b, count(*) - count(DISTINCT ky) s FROM p)
SELECT t::BIGINT AS n_common, a AS splits_a, b AS splits_b, s AS shared, round((a + b - 2 * s) / (a + b), 9) AS rf FROM q, z""")
def bipartition_distance(t):
    return rounded(tr.bipartition_distance(world(t, with_orders=False), regrouped(t))).withColumn("n_common", F.col("n_common").cast("long"))


@query("placement_distance", f"""
WITH RECURSIVE {WORLD_SQL}, rf AS (SELECT 'o' || o_orderkey node FROM orders WHERE o_orderstatus <> 'F'), v AS (SELECT DISTINCT 'c' || o_custkey node FROM orders WHERE o_orderstatus = 'F'),
bc AS (SELECT anc, min(dist) d FROM cl JOIN rf ON rf.node = cl.leaf GROUP BY 1), ch AS (SELECT e.parent anc, e.node child, d + len d FROM bc JOIN e ON e.node = bc.anc),
o AS (SELECT q.leaf v, min(q.dist + ch.d) d FROM cl q JOIN v ON v.node = q.leaf JOIN cl c ON c.leaf = q.leaf AND c.steps = q.steps - 1 JOIN ch ON ch.anc = q.anc AND ch.child <> c.anc GROUP BY 1),
b AS (SELECT v.node v, least(o.d - len / 2, bc.d + len / 2) d FROM v JOIN e USING (node) LEFT JOIN o ON o.v = v.node LEFT JOIN bc ON bc.anc = v.node) SELECT 'x' || o_orderkey AS query, round(d + 0.1, 9) AS dist FROM b JOIN orders ON v = 'c' || o_custkey WHERE o_orderstatus = 'F'""")
def placement_distance(t):
    """Every F order is a query placed half way up the edge of its customer; the other orders are references."""
    e = world(t)
    pl = t.orders.where("o_orderstatus = 'F'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.lit("world").alias("tree"), _name("x", "o_orderkey").alias("query"), _name("c", "o_custkey").alias("node"),
        ((F.abs("c_acctbal") / 10000 + 0.01) / 2).alias("distal"), F.lit(0.1).alias("pendant"))
    return rounded(tr.placement_distance(e, order_nodes(t, Q), pl)).drop("tree")


@query("clade_consensus", f"""
WITH RECURSIVE {WORLD_SQL}{LEAF_SQL}, z AS (SELECT anc, count(*) n, count(*) FILTER (leaf IN (SELECT 'o' || o_orderkey FROM orders WHERE o_orderstatus <> 'P')) nf FROM cl JOIN lf ON lf.node = leaf GROUP BY 1),
p AS (SELECT anc, n FROM z JOIN e ON e.node = anc WHERE n = nf AND n >= 2 AND sup >= 10), f AS (SELECT anc, n, o_orderpriority fam, count(*) k FROM p JOIN cl USING (anc) JOIN orders ON leaf = 'o' || o_orderkey GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY anc ORDER BY k DESC, fam) i, sum(k) OVER (PARTITION BY anc) tot FROM f) SELECT anc AS node, n, fam AS family, round(k / tot, 9) AS share FROM r WHERE i = 1""")
def clade_consensus(t):
    return rounded(tr.clade_consensus(world(t), order_labels(t), order_nodes(t, "o_orderstatus <> 'P'"), 10)).drop("tree")


@query("anchor_infiltration", f"""
WITH RECURSIVE {WORLD_SQL}{LEAF_SQL}, g AS (SELECT 'o' || o_orderkey leaf FROM orders WHERE o_orderstatus = 'O'), z AS (SELECT anc, count(*) n, count(g.leaf) k FROM cl JOIN lf ON lf.node = cl.leaf LEFT JOIN g ON g.leaf = cl.leaf GROUP BY 1),
ok AS (SELECT z.* FROM z JOIN e ON e.node = anc WHERE sup >= 50 AND parent IS NOT NULL AND n > 1 AND n < (SELECT count(*) FROM lf)), a AS (SELECT 'o' || o_orderkey leaf FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000),
m AS (SELECT leaf, max(k / (n - 1)) s FROM cl JOIN a USING (leaf) JOIN ok USING (anc) WHERE steps > 0 GROUP BY 1) SELECT a.leaf, round(coalesce(s, 0), 9) AS in_share, coalesce(s, 0) > 0.5 AS nested FROM a LEFT JOIN m USING (leaf)""")
def anchor_infiltration(t):
    return rounded(tr.anchor_infiltration(world(t), order_nodes(t, "o_orderstatus = 'P' AND o_totalprice > 400000"), order_nodes(t, "o_orderstatus = 'O'"), 50)).drop("tree")


@query("condition_compare", """
WITH t AS (SELECT 'base' tree UNION ALL SELECT 'long'), w AS (SELECT c_custkey k, n_nationkey n, n_regionkey r, c_acctbal a, abs(c_acctbal) / 10000 + 0.01 lc, (n_nationkey % 5 + 1) * 0.25 ln, 0.5 lr FROM customer JOIN nation ON c_nationkey = n_nationkey),
c AS (SELECT tree, k, n, r, a, CASE tree WHEN 'base' THEN lc ELSE lc * lc END::DOUBLE lc, CASE tree WHEN 'base' THEN ln ELSE ln * ln END::DOUBLE ln, CASE tree WHEN 'base' THEN lr ELSE lr * lr END::DOUBLE lr FROM w, t),
f AS (SELECT * FROM c WHERE a > 9000), b1 AS (SELECT tree, n, min(lc) m FROM f GROUP BY 1, 2), b2 AS (SELECT tree, r, min(lc + ln) m FROM f GROUP BY 1, 2), b3 AS (SELECT tree, min(lc + ln + lr) m FROM f GROUP BY 1),
d AS (SELECT c.tree, c.k, least(lc + b1.m, lc + ln + b2.m, lc + ln + lr + b3.m) d FROM c LEFT JOIN b1 USING (tree, n) LEFT JOIN b2 USING (tree, r) JOIN b3 USING (tree) WHERE a <= 9000),
g AS (SELECT x.tree, x.d, y.d b FROM d x JOIN d y ON y.k = x.k AND y.tree = 'base'),
k AS (SELECT tree, rank() OVER (PARTITION BY tree ORDER BY d) + (count(*) OVER (PARTITION BY tree, d) - 1) / 2 x, rank() OVER (PARTITION BY tree ORDER BY b) + (count(*) OVER (PARTITION BY tree, b) - 1) / 2 y FROM g),
s AS (SELECT r_regionkey * 20 + 15 v FROM region UNION ALL SELECT n_nationkey * 4 FROM nation WHERE n_nationkey % 3 > 0)
SELECT tree, n_scored, round(m, 9) AS median_dist, (SELECT round(avg(v), 9) FROM s) AS mean_support, round(rho, 9) AS spearman
FROM (SELECT tree, count(*) n_scored, quantile_cont(d, 0.5) m FROM d GROUP BY 1) JOIN (SELECT tree, corr(x, y) rho FROM k GROUP BY 1) USING (tree)""")
def condition_compare(t):
    a = world(t, with_orders=False).withColumn("tree", F.lit("base"))
    b = world(t, with_orders=False).withColumn("tree", F.lit("long")).withColumn("length", F.col("length") * F.col("length"))
    e = cut(a.unionByName(b))
    refs = e.join(t.customer.where("c_acctbal > 9000").select(_name("c", "c_custkey").alias("node")), "node", "left_semi").select("tree", "node")
    qs = e.join(t.customer.where("c_acctbal <= 9000").select(_name("c", "c_custkey").alias("node")), "node", "left_semi").select("tree", "node")
    return rounded(tr.condition_compare(e, qs, refs, "base"))


@query("deep_node_selection", f"""
WITH RECURSIVE {WORLD_SQL}{LEAF_SQL}, d AS (SELECT leaf node, max(dist) d FROM cl GROUP BY 1), i AS (SELECT node, d FROM d WHERE node NOT IN (SELECT node FROM lf)), p AS (SELECT quantile_cont(d, 0.75) p FROM i),
o AS (SELECT DISTINCT anc FROM cl WHERE steps > 0 AND leaf IN (SELECT 'o' || o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')), r AS (SELECT i.* FROM i JOIN o ON anc = node)
SELECT node, round(d, 9) AS dist FROM r, p WHERE d >= least(p, (SELECT max(d) FROM r))""")
def deep_node_selection(t):
    return rounded(tr.deep_nodes(world(t), order_nodes(t, "o_orderpriority = '1-URGENT'"), 0.75)).drop("tree")


@query("dating_rates", f"""
WITH RECURSIVE {WORLD_SQL}, d AS (SELECT leaf node, max(dist) d FROM cl GROUP BY 1), h AS (SELECT node, (SELECT max(d) FROM d) - d h FROM d),
s AS (SELECT regr_slope(a, h) s FROM (SELECT h, n_nationkey * 10 + 100 a FROM h JOIN nation ON node = 'n' || n_nationkey WHERE n_regionkey < 3))
SELECT node, round(h * s, 4) AS age FROM h, s""")
def dating_rates(t):
    cal = t.nation.where("n_regionkey < 3").select(F.lit("world").alias("tree"), _name("n", "n_nationkey").alias("node"), (F.col("n_nationkey") * 10 + 100).cast("double").alias("age"))
    return rounded(tr.absolute_ages(world(t), cal), 4).drop("tree")


@query("age_period", """SELECT o_orderkey, CASE WHEN o_totalprice / 1000 >= 252 AND o_totalprice / 1000 < 299 THEN 'Permian' WHEN o_totalprice / 1000 >= 66 AND o_totalprice / 1000 < 252 THEN 'Mesozoic' WHEN o_totalprice / 1000 >= 299 THEN 'Precambrian' ELSE 'Recent' END AS period FROM orders""")
def age_period(t):
    return t.orders.select("o_orderkey", tr.period_of(F.col("o_totalprice") / 1000, [("Permian", 252, 299), ("Mesozoic", 66, 252)]).alias("period"))


@query("family_size_level", "SELECT c_custkey, CASE WHEN c_mktsegment LIKE '%BUILD%' THEN 'Genus' WHEN c_mktsegment LIKE '%MACH%' THEN 'Family' ELSE 'Unknown' END AS level FROM customer")
def family_size_level(t):
    return tr.expansion_level(t.customer, "c_mktsegment", [("BUILD", "Genus"), ("MACH", "Family")]).select("c_custkey", "level")
