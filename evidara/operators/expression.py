"""Expression tables, family counts and their summaries, in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.ordering import percentiles, row_numbers
from evidara.session import cut


def replicate_mean(quant: DataFrame, keys: Sequence[str] = ("gene",)) -> DataFrame:
    return quant.groupBy(*keys).agg(F.avg("tpm").alias("tpm"))


def expression_pivot(quant: DataFrame, tissues: Sequence[str], keys: Sequence[str] = ("gene",)) -> DataFrame:
    """keys × tissue mean matrix; the tissue list is given, so no pass looks for it."""
    return quant.groupBy(*keys).pivot("tissue", list(tissues)).agg(F.avg("tpm"))


def tau_index(expr: DataFrame, gene: str = "gene", unexpressed: float | None = 0.0) -> DataFrame:
    """(gene, tau): Σ(1 − x/max)/(n − 1) over measured tissues; null for fewer than two.
    Written as (n − Σx/max)/(n − 1), so one aggregate does it."""
    s = expr.where(F.col("tpm").isNotNull()).groupBy(gene).agg(F.count("*").alias("n"), F.max("tpm").alias("m"), F.sum("tpm").alias("s"))
    value = F.when(F.col("m") == 0, F.lit(unexpressed).cast("double")).otherwise((F.col("n") - F.col("s") / F.col("m")) / (F.col("n") - 1))
    return s.select(gene, F.when(F.col("n") >= 2, value).alias("tau"))


def tissue_enrichment(expr: DataFrame, wanted: Column, threshold: float = 0.8, gene: str = "gene") -> DataFrame:
    """(gene, mean_in, enrichment, tau, top_tissue, specific)."""
    rows = expr.where(F.col("tpm").isNotNull()).withColumn("__in", wanted)
    s = rows.groupBy(gene).agg(
        F.avg(F.when(F.col("__in"), F.col("tpm"))).alias("a"), F.avg(F.when(~F.col("__in"), F.col("tpm"))).alias("b"),
        F.max(F.struct("tpm", F.col("__in").alias("i"), "tissue")).alias("top"),
        F.count("*").alias("n"), F.max("tpm").alias("m"), F.sum("tpm").alias("s"),
    )
    tau = F.when(F.col("n") >= 2, F.when(F.col("m") == 0, 0.0).otherwise((F.col("n") - F.col("s") / F.col("m")) / (F.col("n") - 1)))
    fold = F.when(F.col("a").isNull(), 0.0).when(F.col("b").isNull(), F.col("a")).otherwise((F.col("a") + 0.1) / (F.col("b") + 0.1))
    return s.select(gene, F.coalesce("a", F.lit(0.0)).alias("mean_in"), fold.alias("enrichment"), tau.alias("tau"),
                    F.col("top.tissue").alias("top_tissue"),
                    F.coalesce((tau >= threshold) & (F.col("m") > 0) & F.col("top.i"), F.lit(False)).alias("specific"))


def expression_stats(expr: DataFrame, least: float, wanted: Column, gene: str = "gene") -> DataFrame:
    """Mean, max, median, sample deviation, CV, expressed share, top sample, fold change."""
    rows = cut(expr.select(gene, "sample", "tpm", wanted.alias("__in")))
    med = percentiles(rows, [gene], "tpm", {"median_tpm": 0.5}).drop("n")
    s = rows.groupBy(gene).agg(
        F.avg("tpm").alias("mean_tpm"), F.max("tpm").alias("max_tpm"), F.stddev_samp("tpm").alias("std_tpm"),
        F.count_if(F.col("tpm") >= least).alias("n_expressed"), F.count("*").alias("n"),
        F.min(F.struct((-F.col("tpm")).alias("t"), "sample")).alias("top"),
        F.avg(F.when(F.col("__in"), F.col("tpm"))).alias("a"), F.avg(F.when(~F.col("__in"), F.col("tpm"))).alias("b"),
    )
    fold = F.when(F.col("b") > 0, F.col("a") / F.col("b"))
    return s.join(med, gene).select(
        gene, "mean_tpm", "max_tpm", "median_tpm", "std_tpm", F.when(F.col("mean_tpm") > 0, F.col("std_tpm") / F.col("mean_tpm")).alias("cv"),
        "n_expressed", (F.col("n_expressed") / F.col("n") * 100).alias("pct_expressed"), F.col("top.sample").alias("top_sample"),
        fold.alias("fold_change"), F.coalesce(fold > 2, F.lit(False)).alias("enriched"))


def coexpression(expr: DataFrame, partners: DataFrame, weights: Mapping[str, float], classes: Sequence[str], least: float = 1.0) -> DataFrame:
    """(gene, partner, partner_class, tissue, score): best weighted tissue in which the
    gene and a partner of an allowed class of the same species are both expressed.

    Only whether a (species, tissue) holds a partner, and which one comes first,
    matters, so partners are reduced to one row per (species, tissue) before the join.
    """
    tissue = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    on = expr.where((F.col("tpm") >= least) & F.col("tissue").isin(list(weights)))
    p = on.join(partners.where(F.col("class").isin(list(classes))).select("gene", "class", "pos"), "gene")
    p = p.groupBy("species", "tissue").agg(F.min(F.struct("pos", F.col("gene").alias("partner"), F.col("class").alias("partner_class"))).alias("p"))
    got = on.select("gene", "species", "tissue").join(p, ["species", "tissue"]).select(
        "gene", "p.partner", "p.partner_class", "p.pos", "tissue", F.try_element_at(tissue, F.col("tissue")).alias("score"))
    best = got.groupBy("gene").agg(F.min(F.struct((-F.col("score")).alias("s"), "pos", "tissue", "partner", "partner_class")).alias("b"))
    return best.select("gene", F.col("b.partner").alias("partner"), F.col("b.partner_class").alias("partner_class"),
                       F.col("b.tissue").alias("tissue"), (-F.col("b.s")).alias("score"))


def family_count_matrix(members: DataFrame, species: Sequence[str], most: int = 100) -> DataFrame:
    """og × species counts with 0 for absence; families of 1..``most`` members."""
    got = members.groupBy("og").pivot("species", list(species)).agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(f"`{s}`") for s in species), F.lit(0))
    return got.where((total > 0) & (total <= most))


def significant_families(families: DataFrame, branches: DataFrame, threshold: float) -> DataFrame:
    """Families under the threshold joined to their branch probabilities."""
    return families.where(F.col("family_p") < threshold).join(branches, "og", "left")


def cluster_mapping(members: DataFrame) -> DataFrame:
    """(cluster, member, identity) + representative and size.  The representative is an
    aggregate over its flag."""
    reps = members.groupBy("cluster").agg(F.min(F.when(F.col("is_rep"), F.col("member"))).alias("representative"), F.count("*").alias("size"))
    return members.join(reps, "cluster").select("cluster", "member", "identity", "representative", "size")


def cluster_summary(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"))
    return sizes.agg(
        F.sum("size").alias("n_sequences"), F.count("*").alias("n_clusters"), (1 - F.count("*") / F.sum("size")).alias("reduction"),
        F.count_if(F.col("size") == 1).alias("n_singletons"), F.max("size").alias("max_size"), F.avg("size").alias("mean_size"))


def distinct_taxa(ids: DataFrame, id_map: DataFrame, exclude_references: bool = False) -> DataFrame:
    """(taxid, n) of a set of ids."""
    m = id_map.where(F.col("source_type") != "reference") if exclude_references else id_map
    return ids.join(m.select("id", "taxid"), "id").groupBy("taxid").agg(F.count("*").alias("n"))


def anchor_block_summary(anchors: DataFrame, gene: str) -> DataFrame:
    """(gene, n_blocks, n_anchors): distinct blocks of a gene and the summed block sizes."""
    size = anchors.groupBy("block").agg(F.count("*").alias("size"))
    own = anchors.select(F.col(gene).alias("gene"), "block").distinct()
    return own.join(size, "block").groupBy("gene").agg(F.count("*").alias("n_blocks"), F.sum("size").alias("n_anchors"))


def family_expansion(families: DataFrame, branches: DataFrame, threshold: float, focal: str) -> DataFrame:
    """Per significant family its best expanding branch by (p, larger change, first seen),
    copies of the focal species and the fold over the rough ancestral count."""
    sig = families.where(F.col("family_p") < threshold).select("og", "family_p")
    rows = branches.join(sig, "og").withColumn("p", F.coalesce("branch_p", "family_p"))
    grow = F.col("change") > 0
    open_p = grow & (F.col("p") <= 1.0)
    got = rows.groupBy("og").agg(
        F.min_by(F.struct("branch", "change", "p"), F.when(open_p, F.struct("p", (-F.col("change")).alias("c"), "pos"))).alias("b"),
        F.sum(F.when(grow, F.col("change"))).alias("total"), F.count_if(grow).alias("n_events"),
        F.sum(F.when(F.col("branch").contains(focal), F.col("change")).otherwise(0)).alias("copies"),
    ).where("n_events > 0 AND b IS NOT NULL")
    anc = F.greatest(F.lit(1), F.col("total") - F.col("b.change"))
    return got.select(
        "og", F.col("b.p").alias("expansion_pvalue"), F.col("b.branch").alias("expansion_branch"), F.col("copies").alias("focal_copies"),
        anc.alias("ancestral_copies"), ((anc + F.col("b.change")) / anc).alias("expansion_fold"), F.col("n_events").alias("total_expansion_events"))


def site_summary(sites: DataFrame, alpha: float, key: str = "og") -> DataFrame:
    """Per group: sites, episodic sites (p < alpha and beta+ > 1), share, mean beta+ of
    those, median p; NaN p-values do not count toward the median."""
    p = F.when(~F.isnan("p_value"), F.col("p_value"))
    rows = cut(sites.select(key, p.alias("p"), F.when(~F.isnan("beta_plus"), F.col("beta_plus")).alias("b")))
    hit = F.coalesce((F.col("p") < alpha) & (F.col("b") > 1), F.lit(False))
    s = rows.groupBy(key).agg(
        F.count("*").alias("n_sites_total"), F.count_if(hit).alias("n_sites_episodic"),
        F.round(F.count_if(hit) / F.count("*"), 6).alias("fraction_episodic"), F.avg(F.when(hit, F.col("b"))).alias("mean_beta_plus"))
    return s.join(percentiles(rows, [key], "p", {"median_p_value": 0.5}).drop("n"), key, "left")


def class_distribution(rows: DataFrame, source: str, label: str) -> DataFrame:
    """Counts per (source, label) and over all sources in one pass."""
    return rows.groupingSets([[source, label], [label]], source, label).agg(F.count("*").alias("n")).withColumn(
        source, F.coalesce(F.col(source), F.lit("ALL")))


def assembly_quality_audit(df: DataFrame, min_n: int, min_share: float, min_n50: int) -> DataFrame:
    """(…, pct_of_median, verdict) against the median size of the clade (case ignored)."""
    rows = cut(df.withColumn("__c", F.lower(F.trim("clade"))))
    med = percentiles(rows.where("length > 0"), ["__c"], "length", {"__m": 0.5}).where(F.col("n") >= min_n).drop("n")
    got = rows.join(med, "__c", "left")
    small = F.col("length") < F.col("__m") * min_share
    frag = (F.col("n50") > 0) & (F.col("n50") < min_n50)
    verdict = (
        F.when(F.col("length") <= 0, "UNASSESSED_no_size").when(F.col("__m").isNull(), "UNASSESSED_small_clade")
        .when(small & frag, "FLAG_unusable").when(small, "watch_small_but_contiguous").when(frag, "watch_fragmented_but_complete").otherwise("ok"))
    return got.withColumn("pct_of_median", F.when(F.col("length") > 0, F.round(F.col("length") / F.col("__m") * 100, 1))).withColumn(
        "verdict", verdict).drop("__c", "__m")


def duplicate_accessions(df: DataFrame, base: Column) -> DataFrame:
    return df.groupBy(base.alias("base")).agg(F.count("*").alias("n")).where("n > 1 AND base <> ''")


def verdict_summary(df: DataFrame, key: str, verdict: str) -> DataFrame:
    """(key, n_keep, n_exclude, tier): counts of verdicts and the most frequent tier."""
    return df.groupBy(key).agg(
        F.count_if(F.col(verdict) == "include").alias("n_keep"), F.count_if(F.col(verdict) == "exclude").alias("n_exclude"))


VERDICT = "class string, verdict string, n_infiltrations long, rf double, support_drop double, reasons array<string>"


def verdict_lists(files: DataFrame) -> DataFrame:
    """Verdicts (``path`` unique, ``value`` one JSON object) -> path, class, verdict, list, place, line.

    ``list`` is keep for include, exclude for exclude, null for any other verdict or none, and where no
    class is named; ``place`` counts the classes of a list in alphabetical order (equal ones by path).
    ``line`` is the row of the review table: ``?`` for a missing text or count, 0 for a missing
    number.  An unreadable text is a row without class and verdict."""
    v = F.from_json("value", VERDICT)
    part = lambda n, none: F.coalesce(v[n].cast("string"), F.lit(none))
    number = lambda n, form: F.format_string(form, F.coalesce(v[n], F.lit(0.0)))
    reasons = F.coalesce(F.array_join(v["reasons"], "; "), F.lit(""))
    cells = [part("class", "?"), part("verdict", "?"), part("n_infiltrations", "?"), number("rf", "%.3f"), number("support_drop", "%.1f"),
             F.when(reasons == "", "—").otherwise(reasons)]
    kind = F.when(v["class"].isNull(), None).when(v["verdict"] == "include", "keep").when(v["verdict"] == "exclude", "exclude")
    rows = files.select("path", v["class"].alias("class"), v["verdict"].alias("verdict"), kind.alias("list"),
                        F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    return row_numbers(rows.withColumn("__class", F.coalesce("class", F.lit(""))), ["list"], ["__class", "path"], "place").select(
        "path", "class", "verdict", "list", F.when(F.col("list").isNotNull(), F.col("place")).alias("place"), "line")


def column_sum(df: DataFrame, column: str) -> DataFrame:
    """Sum of a text column with blanks and words as 0."""
    return df.agg(F.sum(F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))).alias("total"))


def percentile_threshold_score(df: DataFrame, value: str, point: float = 0.75) -> DataFrame:
    """``df`` plus ``score``: the value where it lies above the percentile, else 0."""
    src = cut(df)
    at = percentiles(src, [], value, {"p": point}).select("p").scalar()
    return src.withColumn("__p", at).withColumn("score", F.when(F.col(value) > F.col("__p"), F.col(value)).otherwise(
        F.when(F.col(value).isNotNull(), 0.0))).drop("__p")
