import pytest
from pyspark.sql import functions as F

from evidara.operators import trees as tr
from evidara.sources import nested as ns
from evidara.sources import sinks as sk
from evidara.sources import text as tx


def test_fasta_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one two\nACD\nEF\n\n>y\nGG-\n")
    (tmp_path / "b.fa").write_text(">z\tlast\r\nK\r\n")
    got = {r.id: (r.descr, r.seq) for r in tx.read_fasta(spark, str(tmp_path)).collect()}
    assert got == {"x": ("one two", "ACDEF"), "y": ("", "GG-"), "z": ("last", "K")}
    sk.write_fasta(tx.read_fasta(spark, str(tmp_path)), str(tmp_path / "out"))
    assert tx.read_fasta(spark, str(tmp_path / "out")).count() == 3


def test_quant_tree(spark, tmp_path):
    for rel in ("sp/foot/r1", "foot/r1", "eye_SRR12", "plain"):
        (tmp_path / rel).mkdir(parents=True)
        (tmp_path / rel / "quant.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\ng1\t1\t1\t2.5\t3\n")
    got = {(r.species, r.tissue, r.tpm) for r in tx.scan_quant_tree(tx.read_lines(spark, str(tmp_path)), str(tmp_path)).collect()}
    assert got == {("sp", "foot", 2.5), ("default", "foot", 2.5), ("default", "eye", 2.5), ("default", "plain", 2.5)}


def test_anchor_blocks_and_clusters(spark, tmp_path):
    (tmp_path / "a.anchors").write_text("###\nA1\tB1\t1e-5\nA2\tB2\tx\n###\n\n###\nA3\tB3\n")
    got = [(r.block, r.gene_a) for r in tx.scan_anchor_blocks(tx.read_lines(spark, str(tmp_path), whole=True)).orderBy("gene_a").collect()]
    assert got == [(1, "A1"), (1, "A2"), (2, "A3")]


def test_paf_needs_an_identity(spark):
    row = "q\t10\t0\t10\t+\tc\t100\t5\t15\t9\t10\t60"
    df = spark.createDataFrame([(row,)], "value string")
    with pytest.raises(Exception, match="no identity source"):
        tx.scan_paf(df).collect()
    bad = spark.createDataFrame([(row + "\tcs:Z::9!",)], "value string")
    with pytest.raises(Exception, match="no identity source"):
        tx.scan_paf(bad).collect()


def test_newick_reader():
    rows = ns.newick_edges("(('a b':1e-1,B:.2)0.9/95:3{4},(C,D)n5)root;")
    assert [r[1] for r in rows] == [None, 0, 1, 1, 0, 4, 4]
    assert rows[1][2:] == [3.0, "0.9/95", 4] and rows[2][2:4] == [0.1, "a b"] and rows[0][3] == "root"
    with pytest.raises(ValueError):
        ns.newick_edges("(A:x;")


def test_tree_distances(spark):
    trees = spark.createDataFrame([("t", "((A:1,B:2):1,(C:1,D:5):1);")], "tree string, value string")
    e = ns.scan_newick(trees).cache()
    node = {r.label: r.node for r in e.where("label IS NOT NULL").collect()}
    edges = e.select("tree", "node", "parent", "length")
    q = spark.createDataFrame([("t", node["A"]), ("t", node["D"])], "tree string, node long")
    r = spark.createDataFrame([("t", node["B"]), ("t", node["C"])], "tree string, node long")
    got = {x.leaf: (x.ref, x.dist) for x in tr.nearest_refs(edges, q, r, 1).collect()}
    assert got == {node["A"]: (node["B"], 3.0), node["D"]: (node["C"], 6.0)}
    place = spark.createDataFrame([("t", "p", node["A"], 0.25, 0.5)], "tree string, query string, node long, distal double, pendant double")
    # half a unit out, 0.75 up to the parent, 2 down to B
    assert tr.placement_distance(edges, r, place).first()["dist"] == pytest.approx(0.5 + 0.75 + 2)


def test_tag_beyond_the_thousandth(spark):
    row = ["q", "100", "0", "90", "+", "c", "1000", "5", "95", "80", "90", "60"] + [f"x{i}:i:{i}" for i in range(1000)] + ["de:f:0.02"]
    got = tx.scan_paf(spark.createDataFrame([("\t".join(row),)], "value string")).first()
    assert got.chrom == "c" and abs(got.identity - 98.0) < 1e-9


def test_hmm_rows_without_accession_or_score(spark):
    lines = [("t1 - q1 - 1e-5 12.5 0.1",), ("t2 PF00001.23 q1 - 2e-5 n/a 0.1",), ("t3 PF1 q1 - x 1 0",)]
    got = tx.scan_hmm_tblout(spark.createDataFrame(lines, "value string")).orderBy("target").collect()
    assert [(r.target, r.accession, r.score) for r in got] == [("t1", "", 12.5), ("t2", "PF00001", None)]


def test_fields_are_cut_once_a_row(spark):
    df = spark.createDataFrame([("\t".join(["q", "100", "0", "90", "+", "c", "1000", "5", "95", "80", "90", "60", "dv:f:0.5", "de:f:0.02", "de:f:0.9", "cs:Z::9*ac"]),)], "value string")
    plan = tx.scan_paf(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("regexp_extract_all(") == 1
    assert tx.scan_paf(df).first().identity == pytest.approx(98.0)


def test_difference_string(spark):
    texts = [(":9*ac",), ("=ACGT+ac-g~gt100ag",), (":5!",), ("~gt100ag",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(texts, "cs string").select(tx.cs_identity(F.col("cs"))).collect()]
    assert got == [90.0, pytest.approx(400 / 7), None, None, None, None]


def test_branch_json_is_parsed_once_a_row(spark):
    body = '{"branch attributes":{"0":{"k1":{"original name":"a","Rate Distributions":[[2,0.5],[4,0.5]],"p-value":0.01},"k2":{"omega":3}},"1":{"k3":{"original name":"a","omega":9}}}}'
    df = spark.createDataFrame([("f", body), ("g", None), ("h", "{}")], "path string, value string")
    got = ns.scan_branch_json(df)
    assert got._jdf.queryExecution().executedPlan().toString().count("get_json_object(") == 1
    rows = {r.branch_id: (r.path, r.omega_max, r.omega_mean, r.weight_at_max, r.p_value, r.is_selected) for r in got.collect()}
    assert rows["a"] == ("f", 4.0, 3.0, 0.5, 0.01, 1) and rows["k2"][:3] == ("f", 3.0, 3.0) and len(rows) == 2
