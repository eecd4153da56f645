"""Line and record formats.  Every parser takes a DataFrame of text (``value``, and
``path`` where the path carries meaning), so files, tables and streams of lines read
alike; ``read_*`` opens files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus ``value``, computed once a row.  It leaves through ``explode``: of a plain column, a filter above
    would be moved below it with a copy of ``value``, and of what that is made of, for each mention."""
    return df.select(*[F.col(c) for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def read_lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(value, path): lines of every file below ``path``, or one row per file."""
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.text(path, wholetext=whole).select("value", F.col("_metadata.file_path").alias("path"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, descr, seq, path): one record per row; large files are split between records."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, lineSep="\n>").select("value", F.col("_metadata.file_path").alias("path"))
    return scan_fasta(rows)


def scan_fasta(records: DataFrame) -> DataFrame:
    """Records ``header\\nletters\\n…`` (a leading ``>`` is dropped) -> id, descr, seq."""
    text = F.regexp_replace("value", "^>", "")
    cut = F.instr(text, "\n")
    head = F.regexp_replace(F.when(cut > 0, F.substr(text, F.lit(1), cut - 1)).otherwise(text), r"^\s+|\s+$", "")
    body = F.when(cut > 0, F.substr(text, cut + 1)).otherwise("")
    rest = [c for c in records.columns if c != "value"]
    got = records.where(F.col("value").rlike(r"\S")).select(
        F.regexp_extract(head, r"^(\S+)", 1).alias("id"), F.regexp_replace(head, r"^\S+\s*", "").alias("descr"),
        F.regexp_replace(body, r"\s", "").alias("seq"), *rest)
    return got.where("id <> ''")


def sequence_lengths(fasta: DataFrame) -> DataFrame:
    """(id, length) without gaps; the longest where an id repeats."""
    return fasta.groupBy("id").agg(F.max(F.length(F.translate("seq", "-", ""))).alias("length"))


def scan_orthogroups(wide: DataFrame, og: str) -> DataFrame:
    """Wide table (one column per species, comma lists in the cells) -> og, species, gene."""
    species = [c for c in wide.columns if c != og]
    long = wide.unpivot([og], species, "species", "cell").where("cell IS NOT NULL")
    return long.select(F.col(og).alias("og"), "species", F.explode(F.split("cell", r",\s*")).alias("gene")).select(
        "og", "species", F.trim("gene").alias("gene")).where("gene <> ''")


def quant_path_fields(path: Column, root: str) -> tuple[Column, Column, Column]:
    """(species, tissue, replicate) from the place of a quantification file below ``root``:
    species/tissue/replicate, tissue/replicate, or one folder ``tissue_<run accession>``."""
    rel = F.regexp_replace(path, "^.*" + root.rstrip("/") + "/", "")
    parts = F.split(rel, "/")
    n = F.size(parts)
    run = F.regexp_extract(F.get(parts, F.lit(0)), r"^(.+?)_((?:SRR|ERR|DRR)\d+)$", 1)
    flat = F.when(run != "", run).otherwise(F.get(parts, F.lit(0)))
    species = F.when(n >= 4, F.get(parts, F.lit(0))).otherwise("default")
    tissue = F.when(n >= 4, F.get(parts, F.lit(1))).when(n == 3, F.get(parts, F.lit(0))).when(n == 2, flat)
    return species, tissue, F.get(parts, n - 2)


def scan_quant_tree(lines: DataFrame, root: str) -> DataFrame:
    """Lines ``Name Length EffectiveLength TPM NumReads`` with their path -> species,
    tissue, replicate, gene, tpm."""
    f = F.split("value", "\t")
    s, t, r = quant_path_fields(F.col("path"), root)
    got = lines.select(s.alias("species"), t.alias("tissue"), r.alias("replicate"), F.get(f, F.lit(0)).alias("gene"), F.get(f, F.lit(3)).try_cast("double").alias("tpm"))
    return got.where("tpm IS NOT NULL AND tissue IS NOT NULL")


def fields(lines: DataFrame) -> DataFrame:
    """Adds ``f``: the whitespace-separated fields; comments and blank lines go."""
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    return once(lines.where(F.col("value").rlike(r"^\s*[^#\s]")), "f", F.split(text, r"\s+"))


def at(i: int) -> Column:
    return F.get("f", F.lit(i))


def scan_hmm_tblout(lines: DataFrame) -> DataFrame:
    """(target, accession, query, evalue, score); the accession loses its version and is blank for
    "-", a score that is no number is null, rows without e-value go."""
    accession = F.when(at(1) == "-", F.lit("")).otherwise(F.split_part(at(1), F.lit("."), F.lit(1)))
    got = fields(lines).select(at(0).alias("target"), accession.alias("accession"), at(2).alias("query"),
                               at(4).try_cast("double").alias("evalue"), at(5).try_cast("double").alias("score"))
    return got.where("evalue IS NOT NULL")


def scan_foldseek(lines: DataFrame) -> DataFrame:
    """(query, target, fident, alntmscore, evalue, pos): rows of exactly five fields with
    three numbers.  ``pos`` of the input (if any) is kept for ties."""
    keep = [c for c in lines.columns if c == "pos"]
    got = fields(lines).where(F.size("f") == 5).select(at(0).alias("query"), at(1).alias("target"), at(2).try_cast("double").alias("fident"),
                                                       at(3).try_cast("double").alias("alntmscore"), at(4).try_cast("double").alias("evalue"), *keep)
    return got.where("fident IS NOT NULL AND alntmscore IS NOT NULL AND evalue IS NOT NULL")


def best_foldseek(hits: DataFrame) -> DataFrame:
    """Per query the hit with the largest score, the first read on ties."""
    got = hits.groupBy("query").agg(F.max_by(F.struct("target", "fident", "alntmscore", "evalue"), F.struct("alntmscore", (-F.col("pos")).alias("p"))).alias("b"))
    return got.select("query", "b.*")


def cs_identity(cs: Column) -> Column:
    """Percent identity of a difference string: matches / (matches + substitutions +
    inserted + deleted letters), introns skipped; null for an unknown operator."""
    ops = F.regexp_extract_all(cs, F.lit(r":\d+|=[A-Za-z]+|\*[A-Za-z]{2}|[+-][A-Za-z]+|~[A-Za-z]+\d+[A-Za-z]+"), F.lit(0))

    def add(a: Column, x: Column) -> Column:
        mark, more = F.substring(x, 1, 1), F.length(x) - 1
        same = F.when(mark == ":", F.substr(x, F.lit(2)).cast("int")).when(mark == "=", more).otherwise(0)
        apart = F.when(mark == "*", 1).when(mark.isin("+", "-"), more).otherwise(0)
        return F.struct((a["same"] + same).alias("same"), (a["apart"] + apart).alias("apart"), (a["read"] + more + 1).alias("read"))

    def share(a: Column) -> Column:
        n = a["same"] + a["apart"]
        return F.when((a["read"] == F.length(cs)) & (n > 0), 100.0 * a["same"] / n)

    return F.aggregate(ops, F.struct(*[F.lit(0).alias(c) for c in ("same", "apart", "read")]), add, share)


def scan_paf(lines: DataFrame) -> DataFrame:
    """Alignments as placements: identity from the divergence tag (``de`` before ``dv``),
    else from the ``cs`` string; a row with neither is an error."""
    raw = once(lines, "f", F.split("value", "\t")).where(F.size("f") >= 12)
    tags = F.concat(F.lit("\t"), F.array_join(F.slice("f", F.lit(13), F.greatest(F.size("f") - 12, F.lit(1))), "\t"))

    def tag(name: str) -> Column:
        field = F.regexp_extract("tags", f"\t({name}:[^\t]*)", 1)
        return F.when(field != "", F.regexp_replace(field, "^[^:]*:[^:]*:", ""))

    got = raw.select(
        at(0).alias("query"), at(5).alias("chrom"), at(7).try_cast("long").alias("start"), at(8).try_cast("long").alias("end"), at(4).alias("strand"), tags.alias("tags"),
        at(1).try_cast("long").alias("qlen"), at(2).try_cast("long").alias("qs"), at(3).try_cast("long").alias("qe"), at(11).try_cast("double").alias("score"),
    ).where("start IS NOT NULL AND end IS NOT NULL AND qlen IS NOT NULL AND qs IS NOT NULL AND qe IS NOT NULL AND score IS NOT NULL")
    div = F.when(tag("de").isNotNull(), tag("de").try_cast("double")).otherwise(tag("dv").try_cast("double"))
    got = got.withColumn("identity", F.coalesce(100.0 * (1.0 - div), cs_identity(tag("cs"))))
    lost = F.raise_error(F.concat(F.lit("no identity source for "), F.col("query"))).cast("double")
    return got.select("query", "chrom", "start", "end", "strand", F.coalesce("identity", lost).alias("identity"),
                      F.when(F.col("qlen") > 0, 100.0 * (F.col("qe") - F.col("qs")) / F.col("qlen")).otherwise(0.0).alias("coverage"),
                      F.lit("minimap2").alias("method"), "score")


def scan_blast_tab(lines: DataFrame, coords: DataFrame) -> DataFrame:
    """13 tab columns (query, subject, identity, …, query coverage last) joined to the
    subject's coordinates; unknown subjects go.  ``coords``: subject, chrom, start, end, strand."""
    f = once(lines, "f", F.split("value", "\t")).where(F.size("f") >= 13)
    hits = f.select(at(0).alias("query"), at(1).alias("subject"), at(2).try_cast("double").alias("identity"), at(12).try_cast("double").alias("coverage"),
                    at(10).try_cast("double").alias("evalue"), at(11).try_cast("double").alias("score")).where("identity IS NOT NULL AND coverage IS NOT NULL")
    return hits.join(coords, "subject")


def scan_gff(lines: DataFrame) -> DataFrame:
    """(seqid, source, type, start, end, score, strand, phase, attrs, partial): nine tab
    columns, ``k=v;`` attributes as a map."""
    f = once(lines.where(~F.col("value").startswith("#")), "f", F.split("value", "\t")).where(F.size("f") == 9)
    pairs = F.filter(F.split(at(8), ";"), lambda x: F.trim(x).contains("="))
    attrs = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))), F.trim(F.regexp_replace(x, "^[^=]*=", "")))))
    return f.select(at(0).alias("seqid"), at(1).alias("source"), at(2).alias("type"), at(3).try_cast("long").alias("start"), at(4).try_cast("long").alias("end"),
                    at(5).try_cast("double").alias("score"), at(6).alias("strand"), at(7).alias("phase"), attrs.alias("attrs"),
                    F.lower(at(8)).contains("partial=true").alias("partial"))


def gff_placements(gff: DataFrame, method: str, fraction: bool, missing_coverage: float = 0.0) -> DataFrame:
    """mRNA rows as placements; identity may be written as a fraction, and a missing
    coverage becomes a value no gate passes."""
    ident = F.coalesce(F.try_element_at("attrs", F.lit("Identity")), F.try_element_at("attrs", F.lit("identity"))).try_cast("double")
    cov = F.coalesce(F.try_element_at("attrs", F.lit("coverage")), F.try_element_at("attrs", F.lit("Coverage"))).try_cast("double")
    name = F.coalesce(F.split_part(F.try_element_at("attrs", F.lit("Target")), F.lit(" "), F.lit(1)), F.try_element_at("attrs", F.lit("Name")), F.try_element_at("attrs", F.lit("ID")))
    rows = gff.where("type = 'mRNA'").select(name.alias("query"), F.col("seqid").alias("chrom"), (F.col("start") - 1).alias("start"), "end", "strand",
                                             (ident * (100.0 if fraction else 1.0)).alias("identity"), F.coalesce(cov, F.lit(missing_coverage)).alias("coverage"), F.lit(method).alias("method"))
    return rows.where("query IS NOT NULL AND identity IS NOT NULL")


def scan_anchor_blocks(files: DataFrame) -> DataFrame:
    """One row per file (``value`` whole text) -> path, block, gene_a, gene_b, evalue;
    blocks are separated by ``#`` lines, an unreadable e-value is NaN."""
    marked = files.select("path", F.posexplode(F.filter(F.split("value", r"(?m)^#.*$"), lambda b: b.rlike(r"\S"))).alias("block", "text"))
    rows = marked.select("path", (F.col("block") + 1).alias("block"), F.explode(F.split("text", "\n")).alias("line")).withColumn("f", F.split("line", "\t")).where(F.size("f") >= 2)
    return rows.select("path", "block", F.trim(at(0)).alias("gene_a"), F.trim(at(1)).alias("gene_b"), F.coalesce(at(2).try_cast("double"), F.lit(float("nan"))).alias("evalue"))


def scan_collinearity(lines: DataFrame) -> DataFrame:
    """(gene, n): lines ``block gene gene …``; both ends of a pair count once."""
    return fields(lines).where(F.size("f") >= 3).select(F.explode(F.array(at(1), at(2))).alias("gene")).groupBy("gene").agg(F.count("*").alias("n"))


def scan_tm_prediction(lines: DataFrame) -> DataFrame:
    """(seq_id, tm_confidence, tm_count) from columns 1, 3 and 5; a count may read ``6.0``."""
    f = once(lines, "f", F.split("value", "\t")).where(F.size("f") >= 5)
    got = f.select(at(0).alias("seq_id"), at(2).try_cast("double").alias("tm_confidence"), at(4).try_cast("double").cast("int").alias("tm_count"))
    return got.where("tm_confidence IS NOT NULL AND tm_count IS NOT NULL")


def scan_topology(records: DataFrame) -> DataFrame:
    """Three-line records ``>id | kind\\nletters\\ntopology`` -> id, seq, topology."""
    f = F.split(F.regexp_replace("value", "^>", ""), "\n")
    return records.where(F.size(f) >= 3).select(F.regexp_extract(F.get(f, F.lit(0)), r"^([^\s|]+)", 1).alias("id"), F.get(f, F.lit(1)).alias("seq"), F.trim(F.get(f, F.lit(2))).alias("topology"))


def scan_wide_changes(wide: DataFrame, og: str, value: str) -> DataFrame:
    """Wide branch table -> og, branch, value without blanks."""
    long = wide.unpivot([og], [c for c in wide.columns if c != og], "branch", value)
    return long.select(F.col(og).alias("og"), "branch", F.col(value).try_cast("double").alias(value)).where(f"{value} IS NOT NULL")


def scan_family_change(families: DataFrame, changes: DataFrame, probabilities: DataFrame) -> DataFrame:
    """(og, family_p, branch, change, branch_p): zero changes go; p joined on (og, branch)."""
    ch = scan_wide_changes(changes, "og", "change").where("change <> 0").withColumn("change", F.col("change").cast("long"))
    return families.select("og", "family_p").join(ch, "og").join(scan_wide_changes(probabilities, "og", "branch_p"), ["og", "branch"], "left")


def scan_cluster_dump(files: DataFrame) -> DataFrame:
    """Files of ``>Cluster`` sections -> path, cluster, member, is_rep, identity."""
    sec = files.select("path", F.posexplode(F.filter(F.split("value", r"(?m)^>Cluster[^\n]*$"), lambda s: s.rlike(r"\S"))).alias("cluster", "text"))
    rows = sec.select("path", "cluster", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").contains(">") & F.col("line").contains("..."))
    return rows.select("path", "cluster", F.regexp_extract("line", r">(.+?)\.\.\.", 1).alias("member"), F.trim("line").endswith("*").alias("is_rep"),
                       F.regexp_extract("line", r"([\d.]+)%\s*$", 1).try_cast("double").alias("identity"))


def scan_cluster_lines(lines: DataFrame) -> DataFrame:
    """One tab-separated cluster per line (``cluster`` given) -> cluster, member, is_rep."""
    return lines.select("cluster", F.posexplode(F.split(F.trim("value"), "\t")).alias("k", "member")).select("cluster", "member", (F.col("k") == 0).alias("is_rep"))


def scan_id_map(table: DataFrame) -> DataFrame:
    """(key, id, taxid, source_type): an id map row reached by its short or original id."""
    keys = F.explode(F.array_distinct(F.array("short_id", "original_id")))
    return table.select(keys.alias("key"), F.col("short_id").alias("id"), "taxid", "source_type")


def resolve_ids(ids: DataFrame, id_map: DataFrame) -> DataFrame:
    """(id, taxid): through the map, else from the header itself."""
    from evidara.functions.scalars import taxid_from_header

    got = ids.join(id_map.select(F.col("key").alias("id"), F.col("taxid").alias("__t")), "id", "left")
    return got.select("id", F.coalesce("__t", taxid_from_header(F.col("id"), F.lit(""))).alias("taxid"))


def scan_structure_alignment(files: DataFrame) -> DataFrame:
    """(path, tm_score, residues): score line and map of reference position -> residue;
    gapped and malformed rows go."""
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    score = F.get(F.filter(lines, lambda x: F.lower(x).startswith("tm-score")), F.lit(0))
    rows = F.filter(lines, lambda x: x.rlike(r"^\d+\s+\d+\s+[A-Za-z]$"))
    pairs = F.transform(rows, lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("k"), F.upper(F.regexp_extract(x, r"(\w)$", 1)).alias("v")))
    return files.select("path", F.regexp_extract(score, r"\s(\S+)$", 1).try_cast("double").alias("tm_score"),
                        F.map_from_arrays(F.array_distinct(F.transform(pairs, lambda p: p["k"])), F.transform(F.array_distinct(F.transform(pairs, lambda p: p["k"])),
                                          lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"])).alias("residues"))


def scan_hhr(files: DataFrame, max_evalue: float) -> DataFrame:
    """(query, no, hit, prob, evalue, score) of the summary table of a profile search."""
    query = F.regexp_extract("value", r"(?m)^Query\s+(\S+)", 1)
    rows = files.select(query.alias("query"), F.explode(F.split("value", "\n")).alias("line"))
    pat = r"^\s*(\d+)\s+(\S+).*?\s(\d+(?:\.\d+)?)\s+(\d\S*)\s+(\d\S*)\s+(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s+\d+\s+\d+-\d+\s+\d+-\d+"
    hit = rows.where(F.col("line").rlike(pat)).select("query", *[F.regexp_extract("line", pat, i).alias(n) for i, n in ((1, "no"), (2, "hit"), (3, "prob"), (4, "evalue"), (6, "score"))])
    got = hit.select("query", F.col("no").cast("int").alias("no"), "hit", F.col("prob").cast("double").alias("prob"), F.col("evalue").try_cast("double").alias("evalue"), F.col("score").cast("double").alias("score"))
    return got.where(F.col("evalue") <= max_evalue)


def scan_log_blocks(files: DataFrame, block: str, row: str, block_fields: Sequence[str], row_fields: Sequence[str]) -> DataFrame:
    """Text logs -> one row per ``row`` match inside each ``block`` match; the groups of the
    two patterns become the columns."""
    b = files.select(F.explode(F.regexp_extract_all("value", F.lit(block), F.lit(0))).alias("b"))
    r = b.select(*[F.regexp_extract("b", block, i + 1).alias(n) for i, n in enumerate(block_fields)], F.explode(F.regexp_extract_all("b", F.lit(row), F.lit(0))).alias("r"))
    return r.select(*block_fields, *[F.regexp_extract("r", row, i + 1).alias(n) for i, n in enumerate(row_fields)])


def scan_records_dir(lines: DataFrame) -> DataFrame:
    """Per-sample tables (seq_id, gpcr_positive, tm_count, tm_confidence, passed_gate) ->
    taxid, name, and counts per file; taxid and name come from the file name."""
    from evidara.functions.scalars import file_name_fields

    taxid, name = file_name_fields(F.col("path"))
    f = once(lines, "f", F.split("value", "\t")).where((F.size("f") >= 5) & (at(0) != "seq_id"))
    yes = lambda c: F.lower(c).isin("true", "1", "yes")
    return f.select(taxid.alias("taxid"), name.alias("name"), yes(at(1)).alias("p"), yes(at(4)).alias("g")).groupBy("taxid", "name").agg(
        F.count("*").alias("n_input"), F.count_if("p").alias("n_positive"), F.count_if("g").alias("n_passed"))


def scan_asr_state(lines: DataFrame, node: str) -> DataFrame:
    """(node, seq): the reconstructed letters of one node in site order."""
    f = once(lines.where(~F.col("value").startswith("#")), "f", F.split("value", "\t")).where(F.size("f") >= 3)
    rows = f.select(at(0).alias("node"), at(1).try_cast("int").alias("site"), at(2).alias("state")).where((F.col("node") == node) & F.col("site").isNotNull())
    # one entry per site of one node
    return rows.groupBy("node").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("site", "state"))), lambda x: x["state"]), "").alias("seq"))


def scan_uniprot(table: DataFrame) -> DataFrame:
    """Protein records (accession, protein_name, gene_names, similarity, pfam) with family
    and class."""
    from evidara.functions.scalars import class_from_evidence, family_regex_classify

    return table.withColumn("family", family_regex_classify(F.col("protein_name"), F.col("gene_names"))).withColumn(
        "class", class_from_evidence(F.col("similarity"), F.col("pfam")))
