"""Formats written to the shared folder and read back by path, in as many splits as their size gives."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from evidara.plans import sources as src
from evidara.plans.registry import ORACLES, query
from evidara.plans.sources import s
from evidara.session import shared_dir
from evidara.sources import sections as sc
from evidara.sources import text as tx

#: orders or parts whose lines share a file, so that the number of files grows with the table
PER_FILE = 250_000
ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


def folder(t):
    return f"{shared_dir(t.spark)}/files-{uuid.uuid4().hex}"


def through_files(t, lines):
    """``lines`` (value) as files, read back with their paths."""
    path = folder(t)
    lines.select("value").write.text(path)
    return tx.read_lines(t.spark, path)


def ordered_files(t, rows, file, order):
    """``rows`` (value, the columns of ``order``), a file for each value of ``file``, in order, read back as placed lines."""
    path = folder(t)
    rows.withColumn("file", file).repartition("file").sortWithinPartitions("file", *order).select("value", "file").write.partitionBy("file").text(path)
    return sc.read_placed(t.spark, path)


def file_of(path="path"):
    return F.regexp_extract(path, r"/file=(\d+)/", 1).cast("long").alias("file")


@query("read_hmm_tblout", ORACLES["scan_hmm_tblout"])
def read_hmm_tblout(t):
    return tx.scan_hmm_tblout(through_files(t, src.hmm_lines(t)))


@query("read_paf", ORACLES["scan_paf"])
def read_paf(t):
    return tx.scan_paf(through_files(t, src.paf_lines(t))).withColumn("identity", F.round("identity", 6))


@query("read_gff", ORACLES["scan_gff"])
def read_gff(t):
    return src.rounded(tx.gff_placements(tx.scan_gff(through_files(t, src.gff_lines(t))), "miniprot", True), 6)


@query("read_quant_tree", """
SELECT 'species=' || l_returnflag AS species, 'tissue=' || l_linestatus AS tissue, 'replicate=' || l_linenumber AS replicate, 'g' || l_partkey AS gene, l_quantity AS tpm FROM lineitem""")
def read_quant_tree(t):
    path = folder(t)
    row = F.concat_ws("\t", F.concat(F.lit("g"), s("l_partkey")), F.lit("100"), F.lit("90.5"), s("l_quantity"), F.lit("7"))
    place = [F.col("l_returnflag").alias("species"), F.col("l_linestatus").alias("tissue"), F.col("l_linenumber").alias("replicate")]
    head = t.lineitem.select(*place, F.lit("Name\tLength\tEffectiveLength\tTPM\tNumReads").alias("value")).distinct()
    t.lineitem.select(*place, row.alias("value")).unionByName(head).write.partitionBy("species", "tissue", "replicate").text(path)
    return tx.scan_quant_tree(tx.read_lines(t.spark, path), path.rsplit("/", 1)[1])


@query("read_anchor_blocks", f"""
WITH l AS (SELECT *, l_orderkey // {PER_FILE} file, row_number() OVER (PARTITION BY l_orderkey // {PER_FILE} ORDER BY {", ".join(ORDER)}, l_tax) r FROM lineitem),
b AS (SELECT *, lag(l_returnflag) OVER (PARTITION BY file ORDER BY r) before FROM l),
k AS (SELECT *, sum((l_returnflag <> 'R' AND coalesce(before, 'R') = 'R')::INT) OVER (PARTITION BY file ORDER BY r) block FROM b)
SELECT file, block::BIGINT AS block, 'a' || l_partkey AS gene_a, 'b' || l_suppkey AS gene_b, CASE WHEN l_returnflag = 'A' THEN l_tax ELSE 'nan'::DOUBLE END AS evalue FROM k WHERE l_returnflag <> 'R'""")
def read_anchor_blocks(t):
    pair = F.concat_ws("\t", F.concat(F.lit("a"), s("l_partkey")), F.concat(F.lit("b"), s("l_suppkey")), F.when(F.col("l_returnflag") == "A", s("l_tax")).otherwise("bad"))
    rows = t.lineitem.select(*ORDER, "l_tax", F.when(F.col("l_returnflag") == "R", "###").otherwise(pair).alias("value"))
    lines = ordered_files(t, rows, F.floor(F.col("l_orderkey") / PER_FILE), [*ORDER, "l_tax"])
    return sc.anchor_blocks(lines).select(file_of(), "block", "gene_a", "gene_b", "evalue")


@query("read_cluster_dump", f"""
SELECT l_orderkey // {PER_FILE} AS file, dense_rank() OVER (PARTITION BY l_orderkey // {PER_FILE} ORDER BY l_orderkey) - 1 AS cluster, l_orderkey::VARCHAR AS label, 'm' || l_partkey || '_' || l_linenumber AS member,
 l_linenumber = 1 AS is_rep, CASE WHEN l_linenumber > 1 THEN l_quantity END AS identity FROM lineitem""")
def read_cluster_dump(t):
    tail = F.when(F.col("l_linenumber") == 1, "*").otherwise(F.concat(F.lit("at "), s("l_quantity"), F.lit("%")))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("0\t300aa, >m"), s("l_partkey"), F.lit("_"), s("l_linenumber"), F.lit("... "), tail).alias("value"))
    marks = t.lineitem.select("l_orderkey", F.lit(0).alias("l_linenumber"), F.concat(F.lit(">Cluster "), s("l_orderkey")).alias("value")).distinct()
    lines = ordered_files(t, rows.unionByName(marks), F.floor(F.col("l_orderkey") / PER_FILE), ["l_orderkey", "l_linenumber"])
    return sc.cluster_members(lines).select(file_of(), "cluster", "label", "member", "is_rep", "identity")


@query("read_hhr", "SELECT 'q' || l_orderkey AS query, l_linenumber AS no, 'h' || l_partkey AS hit, round(l_quantity, 1) AS prob, l_tax AS evalue, 123.4::DOUBLE AS score FROM lineitem WHERE l_tax <= 0.05")
def read_hhr(t):
    hit = F.concat(F.lit("  "), s("l_linenumber"), F.lit(" h"), s("l_partkey"), F.lit(" some protein  "), s("l_quantity"), F.lit(" "), s("l_tax"), F.lit(" 1E-9  123.4  0.5  120  1-120  3-122 (300)"))
    heads = t.lineitem.select("l_orderkey", F.lit(0).alias("l_linenumber"), F.concat(F.lit("Query         q"), s("l_orderkey"), F.lit(" x\n\n No Hit Prob E-value")).alias("value")).distinct()
    rows = t.lineitem.select("l_orderkey", "l_linenumber", hit.alias("value")).unionByName(heads)
    lines = ordered_files(t, rows, F.floor(F.col("l_orderkey") / PER_FILE), ["l_orderkey", "l_linenumber"])
    return sc.profile_hits(lines, 0.05).withColumn("prob", F.round("prob", 1))


@query("read_structure_alignment", f"""
SELECT p_partkey // {PER_FILE} AS file, 0.5 + p_partkey // {PER_FILE} AS tm_score, p_partkey::INTEGER AS position, CASE WHEN p_size % 5 = 0 THEN 'K' WHEN p_size % 2 = 0 THEN 'Y' ELSE 'W' END AS residue FROM part WHERE p_size % 3 > 0""")
def read_structure_alignment(t):
    file = F.floor(F.col("p_partkey") / PER_FILE)
    seen = F.concat(s("p_partkey"), F.lit("\t"), s("p_size"), F.lit("\t"), F.when(F.col("p_size") % 2 == 0, "y").otherwise("W"))
    again = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("\n"), s("p_partkey"), F.lit("\t1\tk"))).otherwise("")
    line = F.when(F.col("p_size") % 3 > 0, F.concat(seen, again)).otherwise(F.concat(s("p_partkey"), F.lit("\t-\t-")))
    heads = t.part.select(F.concat(F.lit("# aligned\nTM-score\t"), (file + 0.5).cast("string"), F.lit("\nref_resnum\tcand_resnum\tres")).alias("value"), (file * PER_FILE).alias("p_partkey"), F.lit(0).alias("k")).distinct()
    lines = ordered_files(t, t.part.select(line.alias("value"), "p_partkey", F.lit(1).alias("k")).unionByName(heads), file, ["p_partkey", "k"])
    return sc.aligned_residues(lines).where("position IS NOT NULL").select(file_of(), "tm_score", "position", "residue")
