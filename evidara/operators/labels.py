"""Votes, labelings and the gates that rest on them.

Counts are taken per (group, label) before anything is compared, so a group that
holds a large share of the rows shrinks to its distinct labels in the map stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.operators.stats import tasks_for
from evidara.session import cut

#: families that an anchor meets, about: rows it becomes in a task
MET_FAMILIES = 4
# The order that settles a tie between classes, and the word for "none".
CLASS_ORDER = ("A", "B", "C", "F")
UNCLASSIFIED = "unclassified"
UNCLASSIFIED_GROUP = "unclassified-og"


def modal_label(df: DataFrame, keys: Sequence[str], label: str, tie: Column | None = None, weight: str | None = None) -> DataFrame:
    """(keys, label, n_top, n_total, n_tied): the most frequent label of each group.
    ``tie`` (smallest wins, aggregated by min) settles equal counts; default alphabet.
    A row counts once, or ``weight`` times."""
    keys = list(keys)
    tie = F.col(label) if tie is None else tie
    count = F.sum(weight) if weight else F.count("*")
    counts = df.groupBy(*keys, label).agg(count.alias("__n"), F.min(tie).alias("__tie"))
    levels = counts.groupBy(*keys, "__n").agg(
        F.count("*").alias("__tied"), F.min(F.struct("__tie", label)).alias("__w")
    )
    best = levels.groupBy(*keys).agg(
        F.max(F.struct("__n", "__tied", "__w")).alias("__b"), F.sum(F.col("__n") * F.col("__tied")).alias("n_total")
    )
    return best.select(
        *keys, F.col(f"__b.__w.{label}").alias(label), F.col("__b.__n").alias("n_top"), "n_total",
        F.col("__b.__tied").alias("n_tied"),
    )


def og_vote(members: DataFrame, candidates: DataFrame, threshold: float, min_annotated: int) -> DataFrame:
    """Family of each candidate's orthogroup by the vote of its annotated members.

    ``members``: og, member, pos, family, subfamily (family null = not annotated);
    ``candidates``: member, pos.  The vote of a group is taken once and leaves out its
    first candidate; equal counts go to the label seen first.
    """
    first = (
        candidates.select("member", F.col("pos").alias("cpos"))
        .join(members.select("member", "og"), "member")
        .groupBy("og")
        .agg(F.min(F.struct("cpos", "member")).alias("f"))
        .select("og", F.col("f.member").alias("left_out"))
    )
    voters = members.join(first, "og").where((F.col("member") != F.col("left_out")) & F.col("family").isNotNull())
    voters = voters.select("og", "pos", "family", "subfamily")
    fam = modal_label(voters, ["og"], "family", F.col("pos"))
    sub = modal_label(
        voters.where(F.coalesce("subfamily", F.lit("")) != ""), ["og", "family"], "subfamily", F.col("pos")
    ).select(
        "og", "family",
        F.when(F.col("n_top") / F.col("n_total") >= threshold, F.col("subfamily")).otherwise("").alias("subfamily"),
    )
    sizes = members.groupBy("og").agg(F.count("*").alias("n_members"))
    enough = F.col("n_total") >= min_annotated
    share = F.when(enough, F.col("n_top") / F.col("n_total")).otherwise(0.0)
    vote = (
        sizes.join(fam, "og", "left")
        .join(sub, ["og", "family"], "left")
        .select(
            "og", "n_members",
            F.coalesce("n_total", F.lit(0)).alias("n_annotated"),
            F.coalesce(share, F.lit(0.0)).alias("consensus_fraction"),
            F.when(share >= threshold, F.col("family")).otherwise(UNCLASSIFIED_GROUP).alias("og_vote_family"),
            F.when(share >= threshold, F.coalesce("subfamily", F.lit(""))).otherwise("").alias("og_vote_subfamily"),
        )
    )
    homes = candidates.select("member").join(members.select("member", "og"), "member", "left")
    return homes.join(vote, "og", "left").select(
        "member", F.coalesce("og", F.lit("")).alias("og"),
        F.coalesce("og_vote_family", F.lit(UNCLASSIFIED_GROUP)).alias("og_vote_family"),
        F.coalesce("og_vote_subfamily", F.lit("")).alias("og_vote_subfamily"),
        F.coalesce("n_members", F.lit(0)).alias("n_members"),
        F.coalesce("n_annotated", F.lit(0)).alias("n_annotated"),
        F.coalesce("consensus_fraction", F.lit(0.0)).alias("consensus_fraction"),
    )


def og_class_majority(members: DataFrame, min_fraction: float = 0.0, order: Sequence[str] = CLASS_ORDER) -> DataFrame:
    """(og, class) for every group of ``members`` (og, class): plurality of the real
    classes, ties by ``order``; no real vote or too small a share = unclassified."""
    real = F.lower(F.trim("class")) != UNCLASSIFIED
    place = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("class"))
    place = F.when(place == 0, F.lit(len(order) + 1)).otherwise(place)
    won = modal_label(members.where(real), ["og"], "class", F.struct(place, F.col("class")))
    won = won.where(F.col("n_top") / F.col("n_total") >= min_fraction).select("og", "class")
    return members.select("og").distinct().join(won, "og", "left").select(
        "og", F.coalesce("class", F.lit(UNCLASSIFIED)).alias("class")
    )


def contingency(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, a, b).agg(F.count("*").alias("n"))


def per_family_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(family, n_total, tp, fn, fp, recall, precision) over the families that occur
    in ``truth``; precision is null where nothing was predicted."""
    c = contingency(df, truth, predicted)
    hit = F.col(truth) == F.col(predicted)
    rows = c.select(F.col(truth).alias("family"), F.col("n").alias("t"),
                    F.when(hit, F.col("n")).otherwise(0).alias("h"), F.lit(0).cast("long").alias("w"))
    wrong = c.where(~hit).select(F.col(predicted).alias("family"), F.lit(0).cast("long").alias("t"),
                                 F.lit(0).cast("long").alias("h"), F.col("n").alias("w"))
    got = rows.unionByName(wrong).groupBy("family").agg(
        F.sum("t").alias("n_total"), F.sum("h").alias("tp"), F.sum("w").alias("fp")
    )
    return got.where("n_total > 0").select(
        "family", "n_total", "tp", (F.col("n_total") - F.col("tp")).alias("fn"), "fp",
        (F.col("tp") / F.col("n_total")).alias("recall"),
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )


def _marginals(df: DataFrame, a: str, b: str):
    c = cut(contingency(df, a, b))
    return c, c.groupBy(a).agg(F.sum("n").alias("n")), c.groupBy(b).agg(F.sum("n").alias("n"))


def adjusted_rand_index(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row (ari, n); an error for fewer than two items, 1.0 where both
    partitions are trivial."""
    c, rows, cols = _marginals(df, truth, predicted)
    pairs = F.sum(F.col("n") * (F.col("n") - 1) / 2)
    a = rows.agg(pairs.alias("v")).scalar()
    b = cols.agg(pairs.alias("v")).scalar()
    one = c.agg(pairs.alias("ij"), F.sum("n").alias("n")).select("ij", "n", a.alias("a"), b.alias("b"))
    expected = F.col("a") * F.col("b") / (F.col("n") * (F.col("n") - 1) / 2)
    gap = (F.col("a") + F.col("b")) / 2 - expected
    ari = F.when(gap == 0, F.lit(1.0)).otherwise((F.col("ij") - expected) / gap)
    few = F.raise_error(F.lit("adjusted Rand index needs at least two items")).cast("double")
    return one.select(F.when(F.coalesce("n", F.lit(0)) < 2, few).otherwise(ari).alias("ari"), "n")


def v_measure(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row (homogeneity, completeness, v_measure), natural logarithm."""
    c, rows, cols = _marginals(df, truth, predicted)
    n = rows.agg(F.sum("n").cast("double").alias("v")).scalar()

    def entropy(t: DataFrame) -> Column:
        t = t.withColumn("all", n)
        return t.agg((-F.sum(F.col("n") / F.col("all") * F.log(F.col("n") / F.col("all")))).alias("v")).scalar()

    joint = (
        c.join(rows.select(truth, F.col("n").alias("nt")), truth)
        .join(cols.select(predicted, F.col("n").alias("np")), predicted)
        .withColumn("all", n)
    )
    one = joint.agg(
        (-F.sum(F.col("n") / F.col("all") * F.log(F.col("n") / F.col("np")))).alias("ck"),
        (-F.sum(F.col("n") / F.col("all") * F.log(F.col("n") / F.col("nt")))).alias("kc"),
    ).select("ck", "kc", entropy(rows).alias("hc"), entropy(cols).alias("hk"))
    one = one.select(
        F.when(F.col("hc") == 0, 1.0).otherwise(1 - F.col("ck") / F.col("hc")).alias("homogeneity"),
        F.when(F.col("hk") == 0, 1.0).otherwise(1 - F.col("kc") / F.col("hk")).alias("completeness"),
    )
    both = F.col("homogeneity") + F.col("completeness")
    return one.withColumn(
        "v_measure",
        F.when(both == 0, 0.0).otherwise(2 * F.col("homogeneity") * F.col("completeness") / both),
    )


def single_group_anchors(df: DataFrame, keys: Sequence[str], og: str) -> DataFrame:
    """Rows (distinct keys + og) of the anchors that fall into exactly one group."""
    got = df.groupBy(*keys).agg(F.min(og).alias(og), F.max(og).alias("__hi"))
    return got.where(F.col(og) == F.col("__hi")).drop("__hi")


def conflation(df: DataFrame, level: str, family: str, og: str) -> DataFrame:
    """Per level: how far distinct families share one group."""
    by = df.groupBy(level, og, family).agg(F.count("*").alias("n"))
    per = by.groupBy(level, og).agg(F.count("*").alias("fams"), F.sum("n").alias("n"))
    mixed = F.col("fams") > 1
    return per.groupBy(level).agg(
        F.count("*").alias("orthogroups_total"),
        F.count_if(mixed).alias("orthogroups_mixed_family"),
        (F.count_if(mixed) / F.count("*")).alias("frac_orthogroups_mixed"),
        F.sum(F.when(mixed, F.col("n")).otherwise(0)).alias("anchors_in_mixed_orthogroup"),
        (F.sum(F.when(mixed, F.col("n")).otherwise(0)) / F.sum("n")).alias("frac_anchors_in_mixed"),
        F.max("fams").alias("max_families_in_one_orthogroup"),
        F.avg("fams").alias("mean_families_per_orthogroup"),
    )


def fragmentation(df: DataFrame, level: str, family: str, og: str) -> DataFrame:
    """Per level and family: anchors, groups, groups per anchor."""
    by = df.groupBy(level, family, og).agg(F.count("*").alias("n"))
    return by.groupBy(level, family).agg(
        F.sum("n").alias("anchors"), F.count("*").alias("orthogroups"),
        (F.count("*") / F.sum("n")).alias("orthogroups_per_anchor"),
    )


def cross_clade_concordance(anchors: DataFrame, reference_clade: str, skipped_clades: Sequence[str] = ()) -> DataFrame:
    """Per anchor outside ``reference_clade``: the modal family of the reference
    anchors that share a group with it and whether it agrees.

    ``anchors``: accession, clade, family, og.  Families are counted per group first;
    an anchor meets those counts, never the other anchors one by one.
    """
    anchors = cut(anchors)
    # an anchor meets several families, and they are counted where they meet: tasks grow in number, not in size
    parts = tasks_for(MET_FAMILIES * anchors.count(), anchors)
    seeds = anchors.where(F.col("clade") == reference_clade).repartition(parts, "og").groupBy("og", F.col("family").alias("mode")).agg(
        F.count("*").alias("n")
    )
    asked = anchors.where((F.col("clade") != reference_clade) & ~F.col("clade").isin(list(skipped_clades) or [""]))
    met = asked.select("accession", "og").repartition(parts, "og").join(seeds, "og")
    met = met.repartition(parts, "accession").groupBy("accession", "mode").agg(F.sum("n").alias("n"))
    levels = met.groupBy("accession", "n").agg(F.count("*").alias("tied"), F.min("mode").alias("mode"))
    best = levels.groupBy("accession").agg(
        F.max(F.struct("n", "tied", "mode")).alias("b"), F.sum(F.col("n") * F.col("tied")).alias("n_reference")
    )
    who = asked.repartition(parts, "accession").groupBy("accession", "clade", "family").agg(F.count("*").alias("n_groups"))
    got = who.join(best, "accession", "left")
    bucket = (
        F.when(F.col("b").isNull(), "NOT_SPANNED")
        .when(F.col("b.tied") > 1, "AMBIGUOUS")
        .when(F.col("b.mode") == F.col("family"), "AGREE")
        .otherwise("DISAGREE")
    )
    return got.select(
        "accession", "clade", "family", "n_groups", F.coalesce("n_reference", F.lit(0)).alias("n_reference"),
        F.coalesce("b.mode", F.lit("")).alias("mode"), bucket.alias("bucket"),
    )


def gate_loo(
    anchors: DataFrame, sizes: DataFrame, regime: str, max_size: int, min_seeds: int, purity: str,
    min_density: float = 0.0, skipped_clades: Sequence[str] = (),
) -> DataFrame:
    """Hold out each anchor (``regime='leave_one'``) or its whole clade
    (``'leave_clade'``) and ask whether the gate gives its family back.

    ``anchors``: accession, clade, family, characterized, og.  What is held out is a
    (family) or (clade) share of a group's seed counts, so verdicts are computed per
    (group, held-out key) and joined back; anchors never meet each other.
    """
    held = (
        F.when(F.col("characterized"), F.col("family")).otherwise(F.lit(""))
        if regime == "leave_one"
        else F.col("clade")
    )
    rows = cut(anchors.withColumn("held", held))
    # groups and anchors are dealt over tasks that grow in number, not in size
    parts = tasks_for(MET_FAMILIES * rows.count(), rows)
    seeds = rows.where("characterized").repartition(parts, "og").groupBy("og", "family").agg(F.count("*").alias("n"))
    if regime == "leave_one":
        removed = seeds.select("og", F.col("family").alias("held"), "family", F.lit(1).cast("long").alias("gone"))
    else:
        removed = rows.where("characterized").repartition(parts, "og").groupBy("og", "held", "family").agg(F.count("*").alias("gone"))
    asked = rows.where(~F.col("clade").isin(list(skipped_clades) or [""]))
    left = (
        asked.select("og", "held").repartition(parts, "og").distinct()
        .join(seeds, "og")
        .join(removed, ["og", "held", "family"], "left")
        .withColumn("n", F.col("n") - F.coalesce("gone", F.lit(0)))
        .where("n > 0")
    )
    levels = left.groupBy("og", "held", "n").agg(F.count("*").alias("tied"), F.min("family").alias("modal"))
    best = levels.groupBy("og", "held").agg(
        F.max(F.struct("n", "tied", "modal")).alias("b"),
        F.sum(F.col("n") * F.col("tied")).alias("total"),
        F.sum("tied").alias("families"),
    )
    got = asked.select("og", "held", "accession", "clade", "family").repartition(parts, "og").join(sizes.repartition(parts, "og"), "og")
    got = got.repartition(parts, "og", "held").join(best.repartition(parts, "og", "held"), ["og", "held"], "left")
    impure = (
        F.when(F.col("families") > 1, "mixed_family_seeds")
        if purity == "strict"
        else F.when(F.col("b.n") / F.col("total") < 0.8, "impure_seeds")
        if purity == "modal80"
        else F.lit(None).cast("string")
    )
    reason = F.coalesce(
        F.when(F.col("b").isNull(), "no_seed_anchors"),
        F.when(F.col("size") > max_size, "too_large"),
        F.when(F.col("b.tied") > 1, "tied_seed_families"),
        impure,
        F.when(F.col("b.n") < min_seeds, "too_few_seeds"),
        F.when((F.lit(min_density) > 0) & (F.col("size") > 0) & (F.col("b.n") / F.col("size") < min_density), "too_sparse"),
        F.lit(""),
    )
    named = ~reason.isin("no_seed_anchors", "too_large", "tied_seed_families")
    got = got.withColumn("fail_reason", reason).withColumn(
        "assigned_family", F.when(named, F.col("b.modal")).otherwise("")
    )
    pick = got.repartition(parts, "accession").groupBy("accession", "clade", "family").agg(
        F.min(F.struct((F.col("fail_reason") != "").alias("bad"), "size", "og", "assigned_family", "fail_reason")).alias("p")
    )
    outcome = (
        F.when(F.col("p.bad"), "not_recovered")
        .when(F.col("p.assigned_family") == F.col("family"), "recovered_correct")
        .otherwise("recovered_wrong")
    )
    return pick.select(
        "accession", "clade", "family", F.col("p.og").alias("og"), F.col("p.size").alias("size"),
        F.col("p.assigned_family").alias("assigned_family"), F.col("p.fail_reason").alias("fail_reason"),
        outcome.alias("outcome"),
    )


def gate_summary(rows: DataFrame) -> DataFrame:
    """Recovery and precision per clade and over ``ALL``."""
    right = F.count_if(F.col("outcome") == "recovered_correct")
    wrong = F.count_if(F.col("outcome") == "recovered_wrong")
    return rows.rollup("clade").agg(
        F.count("*").alias("n"), (right + wrong).alias("recovered"), right.alias("correct"), wrong.alias("wrong"),
        ((right + wrong) / F.count("*")).alias("recovery"),
        F.when(right + wrong > 0, right / (right + wrong)).otherwise(0.0).alias("precision"),
    ).withColumn("clade", F.coalesce("clade", F.lit("ALL")))


def consensus_three_way(hmm: DataFrame, og: DataFrame, placement: DataFrame | None = None,
                        unvalidated: str = "fallback") -> DataFrame:
    """One verdict per candidate from three classifiers.

    ``hmm``: id, hmm_family, hmm_subfamily, threshold_source; ``og``: id,
    og_vote_family, og_vote_subfamily; ``placement``: id, placement_family,
    placement_subfamily.  A call made below an untested threshold cannot vote.
    """
    got = hmm.join(og, "id", "full")
    has_placement = placement is not None
    if has_placement:
        got = got.join(placement, "id", "full")

    def col(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in got.columns else F.lit("")

    def real(c: Column) -> Column:
        return ~c.isin("", "unclassified-hmm", "unclassified-og", "unclassified-placement")

    untested = col("threshold_source") == unvalidated
    h = F.when(untested, "").otherwise(col("hmm_family"))
    o, p = col("og_vote_family"), col("placement_family")
    two = real(h) & real(o) & (h == o)
    three = two & real(p) & (o == p) if has_placement else F.lit(False)
    any_call = real(h) | real(o) | real(p)
    family = F.when(two, h).otherwise("")
    subs = F.array_distinct(F.array_compact(F.array(
        F.when((h == family) & (col("hmm_subfamily") != ""), col("hmm_subfamily")),
        F.when((o == family) & (col("og_vote_subfamily") != ""), col("og_vote_subfamily")),
        F.when((p == family) & (col("placement_subfamily") != ""), col("placement_subfamily")),
    )))
    raw = col("hmm_family")
    said = F.when(raw == "", "NA").when(untested, F.concat(raw, F.lit("(unvalidated-threshold)"))).otherwise(raw)
    parts = [F.concat(F.lit("hmm:"), said), F.concat(F.lit("og:"), F.when(o == "", "NA").otherwise(o))]
    if has_placement:
        parts.append(F.concat(F.lit("placement:"), F.when(p == "", "NA").otherwise(p)))
    return got.select(
        "id",
        F.when(three, "non-chemoreceptor").when(two, "likely-non-chemoreceptor")
        .otherwise("chemoreceptor-candidate").alias("classification"),
        F.when(three, "high").when(two, "medium").otherwise("NA").alias("classification_confidence"),
        family.alias("classification_family"),
        F.when((family != "") & (F.size(subs) == 1), F.get(subs, F.lit(0))).otherwise("").alias("classification_subfamily"),
        F.concat_ws(";", *parts).alias("classification_evidence"),
        any_call.alias("any_call"),
    )


def evidence_union(sources: Mapping[str, DataFrame], attributes: Sequence[str]) -> DataFrame:
    """Union of sources by id; earlier sources win the attributes and ``source``
    lists every contributor in that order.  One aggregate, no join."""
    stacked = None
    for i, (name, df) in enumerate(sources.items()):
        part = df.select("id", F.lit(i).alias("prio"), F.lit(name).alias("src"), *attributes)
        stacked = part if stacked is None else stacked.unionByName(part)
    got = stacked.groupBy("id").agg(
        F.min_by(F.struct(*attributes), "prio").alias("a"),
        F.array_sort(F.collect_set(F.struct("prio", "src"))).alias("s"),
    )
    return got.select(
        "id", *[F.col(f"a.{c}").alias(c) for c in attributes],
        F.array_join(F.transform("s", lambda x: x["src"]), "+").alias("source"),
    )


def evidence_funnel(df: DataFrame, gates: Mapping[str, Column]) -> DataFrame:
    """Adds ``failed_at``: the first gate a row does not pass, empty for survivors."""
    out = F.lit("")
    for name, ok in reversed(list(gates.items())):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return df.withColumn("failed_at", out)


def funnel_counts(df: DataFrame, gates: Sequence[str]) -> DataFrame:
    """(stage, survivors) in gate order from ``failed_at``; one pass."""
    place = F.array_position(F.array(*[F.lit(g) for g in gates]), F.col("failed_at"))
    reached = F.when(F.col("failed_at") == "", len(gates) + 1).otherwise(place)
    counts = df.agg(
        F.count("*").alias("input"), *[F.count_if(reached > i + 1).alias(g) for i, g in enumerate(gates)]
    )
    return counts.unpivot([], ["input", *gates], "stage", "survivors")


def clade_family_rollup(df: DataFrame, clade: str, family: str, focused: Column, characterized: Column, species: str) -> DataFrame:
    """(clade, family, passing, focused_evidence, functionally_characterized, distinct_species): counts of the
    rows that pass, those with either kind of evidence, and their species."""
    return df.groupBy(F.col(clade).alias("clade"), F.col(family).alias("family")).agg(
        F.count("*").alias("passing"), F.count_if(focused).alias("focused_evidence"),
        F.count_if(characterized).alias("functionally_characterized"), F.countDistinct(species).alias("distinct_species"))


def taxonomic_spread(df: DataFrame, family: str, phylum: str, class_: str, species: str) -> DataFrame:
    """(family, phyla, classes, species): distinct ranks of every family and, as ``ALL``, of the table."""
    counts = [F.countDistinct(c).alias(n) for c, n in ((phylum, "phyla"), (class_, "classes"), (species, "species"))]
    return df.rollup(family).agg(*counts).select(F.coalesce(family, F.lit("ALL")).alias("family"), "phyla", "classes", "species")


def modal_tier_report(df: DataFrame, group: str, tier: str) -> DataFrame:
    """(group, tier, n): rows of each tier in each group."""
    return df.groupBy(group, tier).agg(F.count("*").alias("n"))


def paper_burden(df: DataFrame, key: str, papers: Column) -> DataFrame:
    """(key, min_paper_entry_count): size of the smallest paper behind each entry."""
    cited = df.select(key, F.explode(F.array_distinct(papers)).alias("paper")).where("paper <> ''")
    load = cited.groupBy("paper").agg(F.count("*").alias("entries"))
    return cited.join(load, "paper").groupBy(key).agg(F.min("entries").alias("min_paper_entry_count"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row that comes first per key, found by a map-side minimum."""
    rest = [c for c in df.columns if c not in keys]
    got = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("r"),
        F.count("*").alias("n_rows"),
    )
    return got.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest], "n_rows")
