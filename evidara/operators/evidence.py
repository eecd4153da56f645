"""Joins that bring evidence, ids and provenance together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.functions.scalars import base_accession, hcr_friendly, needs_manual_review, reliability_flag
from evidara.ordering import row_numbers
from evidara.session import cut


def merge_channels(df: DataFrame, channels: Mapping[str, DataFrame | None], id_col: str = "id") -> DataFrame:
    """Left-join optional channels; ``has_<name>_data`` tells which ids each one covers.
    Columns of an earlier join are dropped first, so the join can be repeated; a missing
    channel adds the flag only.  Of several rows of one id the last in the order of their columns is
    taken whole."""
    out = df
    for name, channel in channels.items():
        flag = f"has_{name}_data"
        if channel is None:
            out = out.drop(flag).withColumn(flag, F.lit(False))
            continue
        values = [c for c in channel.columns if c != id_col]
        one = channel.groupBy(id_col).agg(F.max(F.struct(*values)).alias("__row")) if values else channel.select(id_col).distinct()
        one = one.select(id_col, *[F.col("__row")[c].alias(c) for c in values], F.lit(True).alias(flag))
        out = out.drop(flag, *values).join(one, id_col, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out


def add_classification(ranked: DataFrame, consensus: DataFrame, strong: float = 0.1, weak: float = 0.5) -> DataFrame:
    """Classification columns with defaults, demoted score, and the production order
    repeated inside each demotion group."""
    names = ["classification", "classification_confidence", "classification_family", "classification_subfamily", "classification_evidence"]
    defaults = ["chemoreceptor-candidate", "NA", "", "", ""]
    got = ranked.drop(*names).join(consensus.select("id", *names), "id", "left")
    got = got.withColumns({n: F.coalesce(F.col(n), F.lit(d)) for n, d in zip(names, defaults)})
    factor = (
        F.when(F.col("classification") == "non-chemoreceptor", strong)
        .when(F.col("classification") == "likely-non-chemoreceptor", weak).otherwise(1.0)
    )
    review = F.when(needs_manual_review(F.col("classification"), F.col("classification_evidence")) == "yes", "yes").otherwise("")
    got = got.withColumns({
        "needs_manual_review": review, "classification_rank_factor": factor, "rank_score_prefilter": F.col("rank_score"),
        "final_rank_prefilter": F.col("final_rank"),
    }).withColumn("rank_score", F.col("rank_score") * F.col("classification_rank_factor")).withColumn(
        "__down", -F.col("classification_rank_factor")).drop("final_rank")
    return row_numbers(got, [], ["__down", "final_rank_prefilter", "id"], "final_rank").drop("__down")


def add_og_coverage(ranked: DataFrame, members: DataFrame, cds_ids: DataFrame) -> DataFrame:
    """Per candidate the size of its group (og), members with a coding sequence, and
    how far that number can be relied on."""
    have = members.join(cds_ids.select(F.col("id").alias("member")).distinct().withColumn("__has", F.lit(1)), "member", "left")
    sizes = have.groupBy("og").agg(F.count("*").alias("og_n_members"), F.count("__has").alias("og_n_ref_cds"))
    got = ranked.join(sizes, "og", "left").fillna(0, ["og_n_members", "og_n_ref_cds"])
    return got.withColumn("og_dnds_reliability", reliability_flag(F.col("og_n_ref_cds")))


def add_hcr_columns(ranked: DataFrame, lengths: DataFrame, paralogs: DataFrame) -> DataFrame:
    """``lengths``: id, cds_length_bp; ``paralogs``: id, closest_paralog_id, paralog_min_identity."""
    got = ranked.join(lengths, "id", "left").join(paralogs, "id", "left")
    size = F.col("tandem_cluster_size") if "tandem_cluster_size" in ranked.columns else F.lit(None).cast("int")
    return got.withColumn("hcr_probe_friendly", hcr_friendly(F.col("cds_length_bp"), F.col("paralog_min_identity"), size))


def resolve_gene_models(cds: DataFrame, mrna: DataFrame, genes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(protein, gene, chrom, start, end, strand, complete, length, n_tm): the gene named
    by the coding row, else the gene of its parent transcript; partial if any row is;
    missing length and TM count are 0.  Unresolved proteins drop."""
    one = cds.groupBy("protein").agg(F.min("gene").alias("gene"), F.min("parent").alias("parent"), F.max("partial").alias("p1"))
    got = one.join(mrna.select(F.col("mrna").alias("parent"), F.col("gene").alias("via"), F.col("partial").alias("p2")), "parent", "left")
    got = got.select("protein", F.coalesce("gene", "via").alias("gene"), "p1", "p2").join(
        genes.select("gene", "chrom", "start", "end", "strand", F.col("partial").alias("p3")), "gene")
    got = got.join(lengths.select("protein", "length", "n_tm"), "protein", "left")
    partial = F.coalesce("p1", F.lit(False)) | F.coalesce("p2", F.lit(False)) | F.coalesce("p3", F.lit(False))
    return got.select("protein", "gene", "chrom", "start", "end", "strand", (~partial).alias("complete"),
                      F.coalesce("length", F.lit(0)).alias("length"), F.coalesce("n_tm", F.lit(0)).alias("n_tm"))


def separation_violations(probes: DataFrame, reference: DataFrame, prefix: str = "ref_") -> DataFrame:
    """(id, reason) of probes that leak: same id, a reference prefix, or a sequence that
    is byte-identical to a reference one."""
    ids = reference.select("id").distinct()
    seqs = reference.select(F.sha2("seq", 256).alias("h")).distinct()
    p = probes.select("id", F.sha2("seq", 256).alias("h"))
    same = p.join(ids, "id", "left_semi").select("id", F.lit("shared_id").alias("reason"))
    named = p.where(F.col("id").cast("string").startswith(prefix)).select("id", F.lit("reference_prefix").alias("reason"))
    equal = p.join(seqs, "h", "left_semi").select("id", F.lit("identical_sequence").alias("reason"))
    return same.unionByName(named).unionByName(equal)


def outer_integrity(a: DataFrame, b: DataFrame, id_col: str, same: Sequence[str]) -> DataFrame:
    """One row: ids only in one side and, per shared column, the rows that disagree."""
    left = a.select(id_col, F.lit(1).alias("__a"), *[F.col(c).alias(f"__a_{c}") for c in same])
    right = b.select(id_col, F.lit(1).alias("__b"), *[F.col(c).alias(f"__b_{c}") for c in same])
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    return left.join(right, id_col, "full").agg(
        F.count_if(F.col("__b").isNull()).alias("only_left"), F.count_if(F.col("__a").isNull()).alias("only_right"),
        F.count_if(both).alias("n_both"),
        *[F.count_if(both & ~F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}"))).alias(f"differ_{c}") for c in same],
    )


def mapping_gap_audit(anchors: DataFrame, mapped: DataFrame, covered_taxa: DataFrame, group: str) -> DataFrame:
    """Per group: anchors, mapped ones, and the unmapped split into identifier gap
    (the lineage holds a covered taxon) and coverage gap.  ``anchors``: id, group, lineage."""
    got = anchors.join(mapped.select("id").distinct().withColumn("__m", F.lit(True)), "id", "left")
    open_rows = got.where(F.col("__m").isNull()).select("id", F.explode_outer("lineage").alias("taxon"))
    near = open_rows.join(covered_taxa.select("taxon").distinct(), "taxon", "left_semi").select("id").distinct().withColumn("__c", F.lit(True))
    got = got.join(near, "id", "left")
    m = F.col("__m").isNotNull()
    return got.groupBy(group).agg(
        F.count("*").alias("anchors"), F.count_if(m).alias("mapped"),
        F.count_if(~m & F.col("__c").isNotNull()).alias("identifier_gap"), F.count_if(~m & F.col("__c").isNull()).alias("coverage_gap"),
        (F.count_if(m) / F.count("*")).alias("mapped_rate"),
    )


def identifier_recovery(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(id, match, tier, n_matches, organism_ok): best route from an unmapped entry to a
    known one: literal id, id without version, lower-cased name, equal sequence.
    Several different matches on the best route are a conflict.
    Both: id, name, organism, seq."""
    routes = [
        (1, "exact_id", F.col("id")),
        (2, "base_id", base_accession(F.col("id"))),
        (3, "name", F.lower(F.trim("name"))),
        (4, "sequence", F.sha2("seq", 256)),
    ]

    def keys(df: DataFrame) -> DataFrame:
        return df.select("id", "organism", F.explode(F.array(*[
            F.struct(F.lit(p).alias("prio"), F.lit(n).alias("tier"), k.alias("key")) for p, n, k in routes
        ])).alias("k")).select("id", "organism", "k.*").where("key IS NOT NULL AND key <> ''")

    # what a key stands for is summarized first: a name shared by many entries is one row
    have = keys(known).groupBy("prio", "key").agg(
        F.min("id").alias("match"), F.max("id").alias("last"), F.count("*").alias("n_matches"),
        F.min_by("organism", "id").alias("match_organism"),
    )
    hit = keys(asked).join(have, ["prio", "key"])
    best = hit.groupBy("id").agg(F.min_by(F.struct("match", "last", "n_matches", "tier", "organism", "match_organism"), "prio").alias("b"))
    return best.select(
        "id", F.col("b.match").alias("match"), F.col("b.tier").alias("tier"), F.col("b.n_matches").alias("n_matches"),
        (F.col("b.match") != F.col("b.last")).alias("conflict"), (F.col("b.organism") == F.col("b.match_organism")).alias("organism_ok"),
    )


def clade_ceiling(members: DataFrame, organisms: DataFrame, seeds: DataFrame, clades: Sequence[str]) -> DataFrame:
    """Per group with a characterized member: members and distinct species, in total and
    per clade.  ``members``: og, gene, organism; ``organisms``: organism, clade, species."""
    seeded = members.join(seeds.select("gene").distinct(), "gene", "left_semi").select("og").distinct()
    rows = members.join(seeded, "og", "left_semi").join(organisms, "organism")
    return rows.groupBy("og").agg(
        F.count("*").alias("n_members"), F.countDistinct("species").alias("n_species"),
        *[F.count_if(F.col("clade") == c).alias(f"n_{c}") for c in clades],
    )


def lineage_stratum(lineage: Column, rules: Sequence[tuple[str, str]], other: str | None = None) -> Column:
    """First rule (taxon, label) whose taxon is in the lineage array; an empty lineage is
    an error."""
    got = F.coalesce(*[F.when(F.array_contains(lineage, taxon), F.lit(label)) for taxon, label in rules], F.lit(other).cast("string"))
    return F.when(F.size(lineage) > 0, got).otherwise(F.raise_error(F.lit("unresolved lineage")).cast("string"))


def anchor_snapshot(anchors: DataFrame, audit: DataFrame, harvest: DataFrame, not_families: Sequence[str]) -> DataFrame:
    """Class-A anchors with the source of their validation (audit, then harvest, else
    none) and whether the primary analysis uses them.  ``audit`` / ``harvest``: accession, passes."""
    got = anchors.where(F.trim("class") == "A").join(
        audit.select("accession", F.col("passes").alias("__a")), "accession", "left"
    ).join(harvest.select("accession", F.col("passes").alias("__h")), "accession", "left")
    source = F.when(F.col("__a").isNotNull(), "uniprot_audit").when(F.col("__h").isNotNull(), "orthodb_harvest").otherwise("none")
    passes = F.coalesce("__a", "__h", F.lit(False))
    named = ~F.lower(F.coalesce("family", F.lit(""))).isin(list(not_families))
    return got.select(*anchors.columns, F.col("__a").isNotNull().alias("in_audit"), source.alias("validation_source"),
                      passes.alias("pass_class_a"), named.alias("scoreable_family"), (passes & named).alias("use_primary"))


def fill_taxids(rows: DataFrame, source: DataFrame) -> DataFrame:
    """Blank taxids from the source; a row without a source or against it is an error."""
    got = rows.join(source.select("accession", F.col("taxid").alias("__t")), "accession", "left")
    mine, theirs = F.trim(F.coalesce("taxid", F.lit(""))), F.trim(F.coalesce("__t", F.lit("")))
    bad = F.raise_error(F.concat(F.lit("taxid conflict for "), F.col("accession").cast("string"))).cast("string")
    return got.withColumn("taxid", F.when((theirs != "") & ((mine == "") | (mine == theirs)), theirs).otherwise(bad)).drop("__t")


def apply_corrections(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """expected -> new family moves; repeated runs change nothing, any other current
    value is an error.  ``corrections``: accession, expected, new_family."""
    got = rows.join(corrections, "accession", "left")
    ok = F.col("new_family").isNull() | (F.col("family") == F.col("expected")) | (F.col("family") == F.col("new_family"))
    bad = F.raise_error(F.concat(F.lit("family drifted for "), F.col("accession").cast("string"))).cast("string")
    return got.withColumn("family", F.when(ok, F.coalesce("new_family", "family")).otherwise(bad)).drop("expected", "new_family")


def merge_reference_tiers(anchors: DataFrame, additions: Mapping[str, DataFrame], sequences: DataFrame, held_out: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(merged, held): anchors plus labelled tiers that are not there yet; families held
    out go to the second table; an addition without a sequence is an error."""
    new = None
    for tier, df in additions.items():
        part = df.withColumn("tier", F.lit(tier))
        new = part if new is None else new.unionByName(part, allowMissingColumns=True)
    new = new.join(anchors.select("accession"), "accession", "left_anti")
    new = new.join(sequences.select("accession", F.lit(True).alias("__s")), "accession", "left")
    new = new.withColumn("tier", F.when(F.col("__s"), F.col("tier")).otherwise(
        F.raise_error(F.concat(F.lit("no sequence for "), F.col("accession").cast("string"))).cast("string"))).drop("__s")
    held = F.col("family").isin(list(held_out))
    return anchors.unionByName(new.where(~held), allowMissingColumns=True), new.where(held)


def inventory_append(existing: DataFrame, entries: DataFrame, batch: str, statuses: Sequence[str], pos: str = "pos") -> DataFrame:
    """``existing`` and the entries that are new, in the order of ``pos``: neither the taxid nor the version-free
    accession (if there is one) is in ``existing`` or in an entry admitted before.

    An entry that is first among the undecided ones of both its taxid and its accession is
    admitted and shuts out the others of either; the rounds end when nothing is undecided.
    """
    def base(df: DataFrame) -> DataFrame:
        return df.withColumn("__b", base_accession(F.coalesce("accession", F.lit(""))))

    have = base(existing)
    left = base(entries).where(F.col("status").isin(list(statuses)))
    left = left.join(have.select("taxid").distinct(), "taxid", "left_anti")
    left = cut(left.join(have.where("__b <> ''").select("__b").distinct(), "__b", "left_anti"))
    admitted = existing.withColumn("source_batch", F.lit(""))
    while not left.isEmpty():
        first = left.groupBy("taxid").agg(F.min(pos).alias("__t"))
        named = left.where("__b <> ''").groupBy("__b").agg(F.min(pos).alias("__n"))
        ranked = left.join(first, "taxid").join(named, "__b", "left")
        won = cut(ranked.where((F.col(pos) == F.col("__t")) & (F.col("__n").isNull() | (F.col(pos) == F.col("__n")))).drop("__t", "__n"))
        admitted = admitted.unionByName(won.drop("__b", pos).withColumn("source_batch", F.lit(batch)), allowMissingColumns=True)
        left = left.join(won.select("taxid"), "taxid", "left_anti")
        left = cut(left.join(won.where("__b <> ''").select("__b"), "__b", "left_anti"))
    return admitted


def merge_selection_signals(gene_wide: DataFrame, multi_hit: DataFrame, sites: DataFrame, key: str, level: float) -> DataFrame:
    """(key, gene_wide_p, gene_wide_significant, multi_hit_p, multi_hit_significant, n_sites): every key that
    any test has; a test without result is not significant, a missing site count is zero.
    ``gene_wide``: key, gene_wide_p; ``multi_hit``: key, multi_hit_p; ``sites``: key, n_sites."""
    got = gene_wide.join(multi_hit, key, "full").join(sites, key, "full")

    def significant(name: str):
        return F.coalesce(F.col(f"{name}_p") < level, F.lit(False)).alias(f"{name}_significant")

    return got.select(key, "gene_wide_p", significant("gene_wide"), "multi_hit_p", significant("multi_hit"), F.coalesce("n_sites", F.lit(0)).alias("n_sites"))


def restrict_to_ids(df: DataFrame, on: str, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of ``df`` whose ``on`` is among ``ids``; repeated ids change nothing."""
    return df.join(ids.select(F.col(id_col).alias(on)), on, "left_semi").select(*df.columns)


def union_ids(parts: Sequence[DataFrame], id_col: str = "id") -> DataFrame:
    """Every id of any part once."""
    got = parts[0].select(id_col)
    for part in parts[1:]:
        got = got.union(part.select(id_col))
    return got.distinct()


def site_tiers(strict: DataFrame, lenient: DataFrame, key: str) -> DataFrame:
    """(key, tier): ``high_confidence`` in both lists, else ``strict_only`` or ``lenient_only``."""
    a = strict.select(key).distinct().withColumn("__a", F.lit(True))
    b = lenient.select(key).distinct().withColumn("__b", F.lit(True))
    tier = F.when(F.col("__a") & F.col("__b"), "high_confidence").when(F.col("__a"), "strict_only").otherwise("lenient_only")
    return a.join(b, key, "full").select(key, tier.alias("tier"))


def merge_manifests(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All rows of ``first`` and those of ``second`` whose key it lacks; columns that one side lacks are null."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"), allowMissingColumns=True)


def gprotein_classes(focused: DataFrame, general: DataFrame, focused_map: DataFrame, general_map: DataFrame) -> DataFrame:
    """(gene, class, evalue, source): best mapped hit, the focused reference before the
    general one.  hits: gene, subject, evalue; maps: subject, class."""
    a = focused.join(focused_map, "subject").withColumn("prio", F.lit(0)).withColumn("source", F.lit("mollusc_reference"))
    b = general.join(general_map, "subject").withColumn("prio", F.lit(1)).withColumn("source", F.lit("general_reference"))
    got = a.unionByName(b).groupBy("gene").agg(F.min_by(F.struct("class", "evalue", "source", "subject"), F.struct("prio", "evalue", "subject")).alias("b"))
    return got.select("gene", F.col("b.class").alias("class"), F.col("b.evalue").alias("evalue"), F.col("b.source").alias("source"))


def positive_control_lookup(controls: DataFrame, ranked: DataFrame, names: Sequence[str]) -> DataFrame:
    """(control, strategy, id): exact id, then a name equal to the row's whole text, then
    the name as whole words in it.  ``controls``: control, needles (array).

    Controls meet the ids of rows that hold their first word; only these pairs read the texts, where a plain search comes
    before the pattern.
    """
    text = F.lower(F.concat_ws(" ", *names))
    rows = ranked.select("id", text.alias("text"), F.col("final_rank").alias("place"))
    exact = controls.join(rows.select(F.col("id").cast("string").alias("control"), "id", "place"), "control").select("control", F.lit(0).alias("p"), "place", "id")
    asked = controls.select("control", F.explode("needles").alias("needle")).select("control", F.lower(F.trim("needle")).alias("needle")).where("needle <> ''")
    alias = asked.join(rows.withColumnRenamed("text", "needle"), "needle").select("control", F.lit(1).alias("p"), "place", "id")
    first = asked.withColumn("word", F.regexp_extract("needle", r"(\w+)", 1)).where("word <> ''").distinct()
    words = rows.select("id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\w+)"), F.lit(1)))).alias("word"))
    pairs = words.join(first, "word").select(F.col("id").alias("at"), "control", "needle").distinct()
    holds = F.col("text").contains(F.col("needle")) & F.expr("text RLIKE concat('(^|\\\\W)\\\\Q', needle, '\\\\E($|\\\\W)')")
    inside = rows.join(pairs, F.col("id").eqNullSafe(F.col("at")) & holds).select("control", F.lit(2).alias("p"), "place", "id")
    best = exact.unionByName(alias).unionByName(inside).groupBy("control").agg(F.min(F.struct("p", "place", "id")).alias("b"))
    names_of = F.array(F.lit("exact_id"), F.lit("exact_alias"), F.lit("word_boundary"))
    return controls.select("control").join(best, "control", "left").select(
        "control", F.coalesce(F.get(names_of, F.col("b.p")), F.lit("none")).alias("strategy"), F.col("b.id").alias("id"))


def truth_verdict(truth: DataFrame, observed: DataFrame, positive: Sequence[str] = ("non-chemoreceptor", "likely-non-chemoreceptor")) -> DataFrame:
    """(id, error_type, correct, family_correct, subfamily_correct)."""
    got = truth.join(observed, "id", "left")
    want = F.col("expected_classification") == "non-chemoreceptor"
    said = F.coalesce(F.col("classification").isin(list(positive)), F.lit(False))
    kind = F.when(~want & ~said, "TN").when(want & said, "TP").when(said, "FP").otherwise("FN")

    def same(a: str, b: str) -> Column:
        hit = F.col(a) == F.coalesce(F.col(b), F.lit(""))
        return F.when(kind == "TP", hit).when(kind != "TN", F.lit(False))

    return got.select("id", kind.alias("error_type"), (want == said).alias("correct"),
                      same("expected_family", "classification_family").alias("family_correct"),
                      same("expected_subfamily", "classification_subfamily").alias("subfamily_correct"))


def id_code_map(claims: DataFrame, curated: DataFrame) -> DataFrame:
    """(code, species, ambiguous): curated species wins, a code claimed by several species
    stays flagged.  ``claims``: code, species, pos; ``curated``: code, species."""
    c = claims.groupBy("code").agg(F.min_by("species", "pos").alias("first"), F.min("species").alias("lo"), F.max("species").alias("hi"))
    return c.join(curated.withColumnRenamed("species", "cur"), "code", "full").select(
        "code", F.coalesce("cur", "first").alias("species"), F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)).alias("ambiguous"))


def subset_by_ids(wanted: DataFrame, sources: Sequence[DataFrame], key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(found, missing): each wanted id from the first source that holds it."""
    stacked = None
    for i, s in enumerate(sources):
        part = s.withColumn("__p", F.lit(i))
        stacked = part if stacked is None else stacked.unionByName(part)
    rest = [c for c in sources[0].columns if c != key]
    ids = wanted.select(key).distinct()
    found = stacked.join(ids, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*rest), "__p").alias("r"))
    found = found.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])
    return found, ids.join(found.select(key), key, "left_anti")


def outgroup_draw(records: DataFrame, provenance: DataFrame, focal: str, n: int) -> DataFrame:
    """First ``n`` records (by pos) not of the focal provenance; one without provenance
    is an error."""
    got = records.join(provenance.select("id", "provenance"), "id", "left")
    bad = F.raise_error(F.concat(F.lit("no provenance for "), F.col("id").cast("string"))).cast("string")
    got = got.withColumn("provenance", F.coalesce("provenance", bad))
    return got.where(F.col("provenance") != focal).orderBy("pos").limit(n)


def cds_provenance(df: DataFrame, sources: DataFrame, default: str = "native") -> DataFrame:
    one = sources.groupBy("id").agg(F.max("cds_source").alias("cds_source"))
    return df.join(one, "id", "left").withColumn("cds_source", F.coalesce("cds_source", F.lit(default)))


def class_resolution_verdict(ids: DataFrame, records: DataFrame, table: DataFrame, wanted: str = "A") -> DataFrame:
    """(id, resolved_class, verdict, current attributes): KEEP / EVICT / UNRESOLVED."""
    got = ids.join(records.select("id", "resolved_class"), "id", "left").join(table, "id", "left")
    c = F.coalesce("resolved_class", F.lit("UNKNOWN"))
    verdict = F.when(c == wanted, "KEEP").when(c == "UNKNOWN", "UNRESOLVED").otherwise("EVICT")
    return got.withColumn("resolved_class", c).withColumn("verdict", verdict)


def ratify_admissions(rules: DataFrame, records: DataFrame, held: DataFrame, sequences: DataFrame) -> DataFrame:
    """(accession, admitted, reason): the first check a ruled admission fails.
    ``rules``: accession, family, taxid; ``records``: accession, taxid, class;
    ``held``: accession, family; ``sequences``: accession, length."""
    got = (
        rules.join(records.select("accession", F.col("taxid").alias("r_taxid"), F.col("class").alias("r_class")), "accession", "left")
        .join(held.select("accession", F.col("family").alias("h_family")), "accession", "left")
        .join(sequences.select("accession", "length"), "accession", "left")
    )
    reason = (
        F.when(F.col("h_family").isNull(), "not_held").when(F.col("h_family") != F.col("family"), "family_mismatch")
        .when(F.col("r_class").isNull(), "no_record").when(F.col("r_class") != "A", "wrong_class")
        .when(F.col("r_taxid") != F.col("taxid"), "taxid_mismatch").when(F.coalesce("length", F.lit(0)) <= 0, "no_sequence").otherwise("")
    )
    return got.select("accession", (reason == "").alias("admitted"), reason.alias("reason"))


def missing_sequences(proteins: DataFrame, cds: DataFrame, prefix: str) -> DataFrame:
    return proteins.where(F.col("id").startswith(prefix)).join(cds.select("id"), "id", "left_anti")


def conditional_mark(df: DataFrame, active: DataFrame, key: str, column: str, reason: str) -> DataFrame:
    """Sets ``column`` to ``reason`` where it is blank and the key is active elsewhere."""
    hit = active.select(key).distinct().withColumn("__hit", F.lit(True))
    blank = F.coalesce(F.trim(F.col(column)), F.lit("")) == ""
    got = df.join(hit, key, "left")
    return got.withColumn(column, F.when(blank & F.col("__hit"), F.lit(reason)).otherwise(F.col(column))).drop("__hit")


def coverage_guard(requested: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row (requested, matched, share, state): none matched = error, below half = warning."""
    got = requested.select(key).distinct().join(found.select(key).distinct().withColumn("__f", F.lit(1)), key, "left")
    n, m = F.count("*"), F.count("__f")
    one = got.agg(n.alias("requested"), m.alias("matched"))
    share = F.col("matched") / F.col("requested")
    return one.select("requested", "matched", share.alias("share"),
                      F.when(F.col("matched") == 0, "error").when(share < 0.5, "warning").otherwise("ok").alias("state"))


def sequence_dedup(df: DataFrame, gates: Sequence[tuple[str, Column]], probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, steps): rows through ordered gates, then without sequences of ``probes``,
    then one row (smallest id) per sequence; ``steps`` counts survivors."""
    state = F.lit(0)
    ok = F.lit(True)
    for i, (_, gate) in enumerate(gates):
        ok = ok & F.coalesce(gate, F.lit(False))
        state = state + F.when(ok, 1).otherwise(0)
    rows = df.withColumn("__h", F.sha2("seq", 256)).withColumn("__s", state)
    rows = rows.join(probes.select(F.sha2("seq", 256).alias("__h")).distinct().withColumn("__p", F.lit(True)), "__h", "left")
    first = rows.where((F.col("__s") == len(gates)) & F.col("__p").isNull()).groupBy("__h").agg(F.min("id").alias("id"))
    kept = df.join(first.select("id"), "id", "left_semi")
    counts = rows.agg(
        F.count("*").alias("input"), *[F.count_if(F.col("__s") >= i + 1).alias(n) for i, (n, _) in enumerate(gates)],
        F.count_if((F.col("__s") == len(gates)) & F.col("__p").isNull()).alias("not_probe"),
        F.countDistinct(F.when((F.col("__s") == len(gates)) & F.col("__p").isNull(), F.col("__h"))).alias("distinct_sequence"),
    )
    return kept, counts.unpivot([], counts.columns, "step", "n")


def id_assignment(records: DataFrame, existing: DataFrame, prefix: str = "ref") -> DataFrame:
    """(id, short_id, is_new): known ids keep their short id, new ones are numbered per
    taxid after the highest number in use, in order of pos.
    ``records``: id, taxid, pos; ``existing``: id, taxid, number."""
    known = existing.select("id", F.col("number").alias("__n"))
    got = records.join(known, "id", "left")
    fresh = row_numbers(got.where(F.col("__n").isNull()).select("id", "taxid", "pos"), ["taxid"], ["pos", "id"], "k")
    high = existing.groupBy("taxid").agg(F.max("number").alias("high"))
    fresh = fresh.join(high, "taxid", "left").select("id", "taxid", (F.coalesce("high", F.lit(0)) + F.col("k")).alias("n"), F.lit(True).alias("is_new"))
    both = got.where(F.col("__n").isNotNull()).select("id", "taxid", F.col("__n").alias("n"), F.lit(False).alias("is_new")).unionByName(fresh)
    return both.select("id", F.concat_ws("_", F.lit(prefix), F.col("taxid").cast("string"), F.col("n").cast("string")).alias("short_id"), "is_new")


def best_hit(hits: DataFrame, key: str, score: str, margin: float, tie: Sequence[str]) -> DataFrame:
    """(key, best row, ambiguous): the highest score per key, ambiguous when the best score
    of another target is closer than ``margin``.  Two passes of map-side maxima."""
    rest = [c for c in hits.columns if c != key]
    order = F.struct(F.col(score).alias("s"), *[(-F.col(t)).alias(f"t{i}") for i, t in enumerate(tie)])
    best = hits.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("b"))
    best = cut(best)
    near = hits.join(best.select(key, F.col("b.target").alias("__t")), key).where(F.col("target") != F.col("__t"))
    second = near.groupBy(key).agg(F.max(score).alias("second"))
    return best.join(second, key, "left").select(
        key, *[F.col(f"b.{c}").alias(c) for c in rest],
        F.coalesce(F.col(f"b.{score}") - F.col("second") < margin, F.lit(False)).alias("ambiguous"))


def best_assembly(df: DataFrame, require_annotation: bool = True) -> DataFrame:
    """One assembly per taxid: source and annotation, then level, then newest date."""
    from evidara.functions.scalars import assembly_level_rank

    src = F.when(F.col("source") == "RefSeq", 2).when(F.col("source") == "GenBank", 1).otherwise(0)
    rows = df.where(F.col("annotated")) if require_annotation else df
    rest = [c for c in df.columns if c != "taxid"]
    order = F.struct((src * 10 + F.col("annotated").cast("int")).alias("a"), assembly_level_rank(F.col("level")).alias("b"), F.col("date").alias("c"), F.col("accession").alias("d"))
    got = rows.groupBy("taxid").agg(F.max_by(F.struct(*rest), order).alias("b"))
    return got.select("taxid", *[F.col(f"b.{c}").alias(c) for c in rest])
