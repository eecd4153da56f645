"""Nested formats: test-result, placement, protein and assembly JSON, Newick trees."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.sources.text import once

NAN = float("nan")
BRANCH = "struct<`original name`:string,`Rate Distributions`:array<array<double>>,`Corrected P-value`:double,`Uncorrected P-value`:double,`p-value`:double,omega:double>"


def scan_branch_json(files: DataFrame) -> DataFrame:
    """(path, branch_id, omega, omega_max, omega_mean, weight_at_max, n_rate_classes,
    p_value, corrected_p_value, is_already_corrected, is_selected) from ``branch
    attributes``, with or without a layer of numbered partitions; the first entry of a
    branch id stays."""
    raw = F.get_json_object("value", "$['branch attributes']")
    top = once(files.select("path", "value"), "top", F.map_entries(F.from_json(raw, "map<string,string>")))
    top = once(top, "parts", F.forall("top", lambda e: e["key"].rlike(r"^\d+$")))
    each = top.select("path", "parts", F.posexplode("top").alias("i", "e"))
    inner = F.when(F.col("parts"), F.map_entries(F.from_json("e.value", "map<string,string>"))).otherwise(F.array(F.col("e")))
    flat = each.select("path", "i", F.posexplode(inner).alias("j", "x")).select("path", "i", "j", F.col("x.key").alias("key"), F.col("x.value").alias("text"))
    flat = once(flat, "b", F.from_json("text", BRANCH)).where("b IS NOT NULL")
    rates = F.col("b.`Rate Distributions`")
    n = F.coalesce(F.size(F.when(F.size(rates) > 0, rates)), F.lit(0))
    top_rate = F.array_max(F.transform(rates, lambda r: r[0]))
    at_max = F.get(F.filter(rates, lambda r: r[0] == top_rate), F.lit(0))[1]
    mean = F.aggregate(rates, F.lit(0.0), lambda a, r: a + r[0] * r[1])
    flat_omega = F.coalesce(F.col("b.omega"), F.lit(1.0))
    raw_p = F.coalesce(F.col("b.`Uncorrected P-value`"), F.col("b.`p-value`"), F.lit(1.0))
    done = F.col("b.`Corrected P-value`")
    got = flat.select(
        "path", "i", "j", F.coalesce(F.col("b.`original name`"), "key").alias("branch_id"),
        F.when(n > 0, mean).otherwise(flat_omega).alias("omega"), F.when(n > 0, top_rate).otherwise(flat_omega).alias("omega_max"),
        F.when(n > 0, mean).otherwise(flat_omega).alias("omega_mean"), F.when(n > 0, at_max).otherwise(F.lit(NAN)).alias("weight_at_max"),
        n.alias("n_rate_classes"), raw_p.alias("p_value"), F.coalesce(done, raw_p).alias("corrected_p_value"), done.isNotNull().cast("int").alias("is_already_corrected"))
    got = got.withColumn("is_selected", ((F.col("corrected_p_value") < 0.05) & (F.col("omega_max") > 1)).cast("int"))
    rest = [c for c in got.columns if c not in ("path", "branch_id", "i", "j")]
    one = got.groupBy("path", "branch_id").agg(F.min_by(F.struct(*rest), F.struct("i", "j")).alias("r"))
    return one.select("path", "branch_id", "r.*")


def scan_genewide_json(files: DataFrame) -> DataFrame:
    """(path, p_value, lrt, omega/prop low, mid, high): rate classes in order; the middle
    is NaN for fewer than three."""
    classes = F.coalesce(F.get_json_object("value", "$['fits']['Unconstrained model']['Rate Distributions']['Test']"), F.lit("[]"))
    pairs = F.array_sort(F.transform(F.from_json(classes, "array<array<double>>"), lambda r: F.struct(r[0].alias("o"), r[1].alias("w"))))
    rows = files.select("path", F.get_json_object("value", "$['test results']['p-value']").try_cast("double").alias("p_value"),
                        F.get_json_object("value", "$['test results']['LRT']").try_cast("double").alias("lrt"), pairs.alias("c"))
    n = F.size("c")

    def pick(i: Column, ok: Column, f: str) -> Column:
        return F.coalesce(F.when(ok, F.get("c", i)[f]), F.lit(NAN))

    out = []
    for name, i, ok in (("low", F.lit(0), n > 0), ("mid", F.lit(1), n >= 3), ("high", n - 1, n > 0)):
        out += [pick(i, ok, "o").alias(f"omega_{name}"), pick(i, ok, "w").alias(f"prop_{name}")]
    return rows.select("path", F.coalesce("p_value", F.lit(NAN)).alias("p_value"), F.coalesce("lrt", F.lit(NAN)).alias("lrt"), *out)


def scan_site_json(files: DataFrame) -> DataFrame:
    """(path, site, alpha, beta_plus, p_value): columns found by their header text."""
    heads = F.from_json(F.get_json_object("value", "$.MLE.headers"), "array<array<string>>")
    names = F.transform(heads, lambda h: F.lower(h[0]))
    content = F.get_json_object("value", "$.MLE.content['0']")
    rows = files.select("path", names.alias("h"), F.posexplode(F.from_json(content, "array<array<double>>")).alias("k", "r"))

    def col(*texts: str) -> Column:
        hits = F.filter(F.transform(F.col("h"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: F.lit(False) | _any(s["x"], texts))
        return F.coalesce(F.get("r", F.get(hits, F.lit(0))["i"]), F.lit(NAN))

    return rows.select("path", (F.col("k") + 1).alias("site"), col("alpha").alias("alpha"), col("&beta;+", "beta+", "beta_plus").alias("beta_plus"), col("p-value").alias("p_value"))


def _any(x: Column, texts) -> Column:
    out = F.lit(False)
    for t in texts:
        out = out | x.contains(t)
    return out


def scan_embeddings(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, width, vec): embedding rows with their length, components as doubles; rows without a vector go."""
    return df.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), F.size(vec).alias("width"), F.col(vec).cast("array<double>").alias("vec"))


def scan_placement_json(files: DataFrame) -> DataFrame:
    """(path, query, edge_num, lwr): per query the placement row with the largest finite
    weight; NaN where a query has none."""
    shape = "struct<fields:array<string>,placements:array<struct<n:array<string>,nm:array<array<string>>,p:array<array<double>>>>>"
    doc = files.select("path", F.from_json("value", shape, {"allowNonNumericNumbers": "true"}).alias("d"))
    e = (F.array_position("d.fields", "edge_num") - 1).cast("int")
    w = (F.array_position("d.fields", "like_weight_ratio") - 1).cast("int")
    rows = doc.select("path", e.alias("e"), w.alias("w"), F.explode("d.placements").alias("x"))
    named = rows.select("path", "e", "w", F.explode(F.coalesce(F.transform("x.nm", lambda m: m[0]), F.col("x.n"))).alias("query"), F.col("x.p").alias("p"))
    each = named.select("path", "query", "e", "w", F.posexplode("p").alias("k", "r")).select("path", "query", "k", F.get("r", F.col("e")).alias("edge"), F.get("r", F.col("w")).alias("lwr"))
    good = F.when(~F.isnan("lwr"), F.col("lwr"))
    got = each.groupBy("path", "query").agg(F.max_by(F.struct("edge", "lwr"), F.struct(F.coalesce(good, F.lit(-1.0)).alias("g"), (-F.col("k")).alias("k"))).alias("b"))
    return got.select("path", "query", F.col("b.edge").cast("int").alias("edge_num"), F.coalesce("b.lwr", F.lit(NAN)).alias("lwr"))


def evidence_codes(entry: Column) -> Column:
    """Distinct evidence codes anywhere in a protein entry, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(entry, F.lit(r'"evidenceCode"\s*:\s*"(ECO:\d+)"'), F.lit(1))))


def scan_evidence_json(rows: DataFrame) -> DataFrame:
    """(accession, reviewed, phylum, evidence_codes, class, class_basis) of protein entries."""
    from evidara.functions.scalars import class_from_evidence

    v = F.col("value")
    lineage = F.from_json(F.get_json_object(v, "$.organism.lineage"), "array<string>")
    known = F.array(*[F.lit(p) for p in ("Mollusca", "Annelida", "Platyhelminthes", "Brachiopoda", "Phoronida", "Nemertea", "Rotifera", "Bryozoa", "Arthropoda", "Nematoda", "Chordata", "Cnidaria")])
    sim = F.regexp_extract(v, r'(Belongs to the G[- ]?protein[- ]coupled receptor \d+ family)', 1)
    pf = F.array_join(F.regexp_extract_all(v, F.lit(r'"(PF\d{5})"'), F.lit(1)), ";")
    cls = class_from_evidence(sim, pf)
    return rows.select(
        F.get_json_object(v, "$.primaryAccession").alias("accession"), F.coalesce(F.get_json_object(v, "$.entryType"), F.lit("")).contains("reviewed").alias("reviewed"),
        F.coalesce(F.get(F.array_intersect(lineage, known), F.lit(0)), F.lit("")).alias("phylum"), evidence_codes(v).alias("evidence_codes"), cls.alias("class"),
        F.when(sim != "", "curated").when(cls != "UNKNOWN", "domain").otherwise("").alias("class_basis"))


ASSEMBLY = "accession string, source_database string, organism struct<tax_id:long,organism_name:string>, assembly_info struct<assembly_level:string,release_date:string>, annotation_info struct<status:string,stats:struct<gene_counts:struct<protein_coding:long>>>, assembly_stats struct<contig_n50:long,total_sequence_length:string>"


def scan_assembly_jsonl(lines: DataFrame) -> DataFrame:
    """(accession, taxid, binomial, source, level, date, annotated, n_proteins, n50, length)
    of assembly reports, one JSON object per line; records without a taxid go."""
    r = lines.select(F.from_json("value", ASSEMBLY).alias("r")).select("r.*").where("organism.tax_id IS NOT NULL")
    src = F.when(F.col("source_database").contains("REFSEQ") | F.col("accession").startswith("GCF_"), "RefSeq").otherwise("GenBank")
    return r.select(
        "accession", F.col("organism.tax_id").alias("taxid"), F.coalesce("organism.organism_name", F.lit("")).alias("binomial"), src.alias("source"),
        F.coalesce("assembly_info.assembly_level", F.lit("")).alias("level"), F.coalesce("assembly_info.release_date", F.lit("")).alias("date"),
        F.col("annotation_info").isNotNull().alias("annotated"), F.coalesce("annotation_info.stats.gene_counts.protein_coding", F.lit(0)).alias("n_proteins"),
        F.coalesce("assembly_stats.contig_n50", F.lit(0)).alias("n50"), F.coalesce(F.col("assembly_stats.total_sequence_length").try_cast("long"), F.lit(0)).alias("length"))




def newick_edges(text: str):
    """(node, parent, length, label, edge) rows of one tree; nodes are numbered as met."""
    rows, path, fresh, i, n = [], [], 0, 0, len(text)
    rows.append([0, None, None, None, None])
    path.append(0)
    fresh = 1
    here = 0
    while i < n:
        c = text[i]
        if c in "(,":
            parent = here if c == "(" else rows[here][1]
            rows.append([fresh, parent, None, None, None])
            here, fresh = fresh, fresh + 1
            i += 1
        elif c == ")":
            here = rows[here][1]
            i += 1
        elif c == ";":
            break
        elif c == "[":
            i = text.index("]", i) + 1
        elif c.isspace():
            i += 1
        else:
            m = re.compile(r"('(?:[^']|'')*'|[^(),;:{}\[\]\s]+)?(?::\s*([-+.\deE]+))?(?:\{(\d+)\})?").match(text, i)
            if m.end() == i:
                raise ValueError(f"unreadable tree at place {i}")
            label, length, edge = m.groups()
            if label:
                rows[here][3] = label.strip("'").replace("''", "'")
            if length:
                rows[here][2] = float(length)
            if edge:
                rows[here][4] = int(edge)
            i = m.end()
    return rows


def scan_newick(trees: DataFrame) -> DataFrame:
    """(tree, node, parent, length, label, edge) from (tree, value), one tree per row.
    The text of one tree is read in one go; trees are spread over the tasks."""
    schema = T.StructType([trees.schema["tree"], T.StructField("node", T.LongType()), T.StructField("parent", T.LongType()), T.StructField("length", T.DoubleType()),
                           T.StructField("label", T.StringType()), T.StructField("edge", T.LongType())])

    def read(batches):
        for pdf in batches:
            out = [(k, *row) for k, text in zip(pdf["tree"], pdf["value"]) for row in newick_edges(text)]
            got = pd.DataFrame(out, columns=["tree", "node", "parent", "length", "label", "edge"])
            for c in ("node", "parent", "edge"):
                got[c] = pd.array(got[c], dtype="Int64")
            yield got

    return trees.select("tree", "value").mapInPandas(read, schema)
