"""Column expressions: scores, names, sequences.  All run inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------------
# Old column names and the names that replaced them.
LEGACY_COLUMNS = {
    "lse_depth_score": "lse_divergence_score",
    "lse_depth_score_norm": "lse_divergence_score_norm",
    "has_lse_depth_data": "has_lse_divergence_data",
}
# Names of chemoreceptors; a name counts where it stands alone between non-alphanumerics.
CHEMORECEPTOR_PATTERN = (
    r"(?i)(^|[^a-z0-9])("
    r"olfr\d*|or\d+[a-z]?\d*|olfactory\s*receptor|odorant\s*receptor"
    r"|taste\s*receptor|tasr\d*|t[12]r\d*|vomero(?:nasal)?(?:\s*receptor)?|v[12]r\d*"
    r"|formyl[\s_-]?peptide(?:\s*receptor)?|fpr\d*"
    r"|trace[\s_-]?amine(?:[\s_-]?associated)?(?:\s*receptor)?|taar\d*"
    r"|gustatory(?:\s*receptor)?|chemosensory(?:\s*receptor)?|chemoreceptor"
    r")([^a-z0-9]|$)"
)
# Receptor families told apart by protein name, in order; the guard comes first.
FAMILY_GUARD = r"gonadotropin[- ]releasing|gonadoliberin|\bGNRHR?\b"
FAMILY_RULES = (
    ("chemokine", r"chemokine receptor|chemokine.*receptor|\bCCR\d|\bCXCR\d|\bCX3CR1\b|\bXCR1\b|\bACKR\d"),
    ("glycoprotein-hormone", r"thyrotropin receptor|thyroid-stimulating hormone receptor|"
     r"follicle-stimulating hormone receptor|follitropin|lutropin|luteinizing hormone receptor|choriogonadotropin|glycoprotein hormone"),
    ("nucleotide", r"adenosine receptor|purinoceptor|purinergic receptor P2Y|\bADORA\d|\bP2RY\d|\bP2Y\d"),
    ("lipid", r"prostaglandin|prostacyclin|prostanoid|thromboxane|cannabinoid receptor|sphingosine 1-phosphate|"
     r"lysophosphatidic acid|free fatty acid receptor|leukotriene|oxoeicosanoid|platelet-activating factor|"
     r"oxysterol|hydroxycarboxylic acid receptor"),
)
CLASS_OF_CURATED_FAMILY = {"1": "A", "2": "B", "3": "C"}
CLASS_OF_DOMAIN = {"PF00001": "A", "PF00002": "B", "PF00003": "C"}
# Names that commit to no function.
UNCHARACTERIZED = (
    r"\borphan\b|\buncharacteri[sz]ed\b|\bputative\b|\bprobable\b|\bpredicted\b|\bhypothetical\b|\bunknown\b|"
    r"\bunnamed\b|\blike protein\b|\bfragment\b|receptor[- ]like\b|\blike[- ]receptor\b|[- ]like\b"
)
PLACEHOLDER = (
    r"^(?:G[- ]?protein[- ]coupled receptor|GPCR|G[- ]?protein receptor|seven transmembrane[- ]?\w*|7TM \w*)\s*[-_ ]?\d*$"
    r"|^GCR\d+$|^GPR\d+$|^[A-Z]{1,3}\d{1,4}$|^LOC\d+$|^(?:GPCR|GCR|Receptor)[-_ ]?\d+$"
)
ABBREVIATION_WITH_NUMBER = r"^[A-Za-z]{2,8}[-_ ]?\d{1,4}[A-Za-z]?$"
FUNCTION_WORD = (
    r"opsin|rhodopsin|receptor|hormone|serotonin|dopamine|adrenergic|histamine|octopamine|tyramine|muscarinic|"
    r"melatonin|corazonin|tachykinin|kinin|orexin|gastrin|somatostatin|opioid|purinoceptor|prostaglandin|"
    r"prostanoid|thromboxane|cannabinoid|leukotriene|chemokine|allatotropin|allatostatin|adipokinetic|sulfakinin"
)
BARE_LABELS = (
    "g protein coupled receptor", "g-protein coupled receptor", "gpcr", "receptor", "g protein coupled receptor 1",
    "seven transmembrane receptor", "rhodopsin like receptor",
)
ASSEMBLY_LEVELS = {"Complete Genome": 4, "Chromosome": 3, "Scaffold": 2, "Contig": 1, "": 0}
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
OLFACTORY_PARTNERS = ("Golf", "Gi", "Go")
# Loop length and pocket volume between which a receptor turns from small-molecule to peptide.
LOOP_RANGE = (10.0, 20.0)
POCKET_RANGE = (600.0, 1200.0)
STRUCTURE_SUFFIXES = r"(?i)(?<=.)\.(gz|bcif|mmcif|cif|pdb|ent)$"
FASTA_SUFFIXES = r"\.(aa\.fna|fasta|faa|fna|fa)$"
DARK_LABELS = ("", "na", "unclassified-hmm", "unclassified-og", "unclassified-placement")
CODON_ORDER = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# -----------------------------------------------------------------------------------


def legacy_column_alias(df: DataFrame, names: Mapping[str, str] = LEGACY_COLUMNS) -> DataFrame:
    """Old column names become the new ones; a new name already there wins."""
    have = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in have and new not in have})


def reference_category_weight(name: Column, high: float = 2.0, other: float = 1.0, mapped: Column | None = None,
                              listed: Column | None = None) -> Column:
    """Weight of a reference: mapped value, else ``high`` for a listed or
    chemoreceptor name, else ``other``."""
    known = F.coalesce(listed, F.lit(False)) if listed is not None else F.lit(False)
    by_name = F.when(known | name.rlike(CHEMORECEPTOR_PATTERN), F.lit(high)).otherwise(F.lit(other))
    by_name = F.when(F.coalesce(name, F.lit("")) == "", F.lit(other)).otherwise(by_name)
    return F.coalesce(mapped.cast("double"), by_name) if mapped is not None else by_name


def support_label_parse(label: Column) -> tuple[Column, Column]:
    """(value, is_percent): the last part of ``a/b`` is a percentage, a bare number has
    an unknown scale, anything else is unmeasured (null)."""
    text = F.trim(F.coalesce(label, F.lit("")))
    parts = F.transform(F.split(text, "/"), lambda p: F.trim(p).try_cast("double"))
    joint = text.contains("/")
    good = ~F.exists(parts, lambda p: p.isNull())
    return F.when(good, F.element_at(parts, -1)), F.when(good, joint)


def support_scale_resolve(df: DataFrame, tree: str, value: str, percent: str, out: str = "support") -> DataFrame:
    """Percent support: bare values of a tree are times 100 when none of them exceeds 1."""
    top = df.where(~F.col(percent)).groupBy(tree).agg(F.max(value).alias("__top"))
    scale = F.when(F.col(percent) | (F.col("__top") > 1.0), 1.0).otherwise(100.0)
    return df.join(top, tree, "left").withColumn(out, F.col(value) * scale).drop("__top")


def selection_score(omega: Column, p: Column, purifying_weight: float = 0.0, positive_weight: float = 1.0,
                    threshold: float = 0.05, boost: float = 1.5) -> tuple[Column, Column, Column]:
    """(purifying, positive, significant) from the branch rate and corrected p."""
    known = omega.isNotNull() & ~F.isnan(omega)
    sig = known & F.coalesce(~F.isnan(p) & (p < threshold), F.lit(False))
    up = F.when(sig, boost).otherwise(1.0)
    pur = F.when(known & (omega < 1), F.abs(F.log10(F.greatest(omega, F.lit(1e-9))))).otherwise(0.0)
    pos = F.when(known & (omega > 1), F.log10(omega)).otherwise(0.0)
    return pur * purifying_weight * up, pos * positive_weight * up, sig


def tandem_score(size: Column, cap: int = 20) -> Column:
    return F.log1p(size) / math.log1p(cap)


def synteny_log_norm(df: DataFrame, count: str, out: str, min_max: int = 5) -> DataFrame:
    """ln(1 + c) / ln(1 + max); nothing is scored while the table's max is small."""
    top = df.agg(F.max(count).alias("v")).scalar()
    got = df.withColumn("__top", top)
    score = F.when(F.col(count) > 0, F.log1p(F.col(count)) / F.log1p(F.col("__top"))).otherwise(0.0)
    return got.withColumn(out, F.when(F.col("__top") >= min_max, score)).drop("__top")


def tissue_weights(tissues: Sequence[str], spec: str) -> dict[str, float]:
    """``a:2,b:1`` over a fixed list of tissues; the rest weigh 1, an unknown one is an error."""
    out = {t: 1.0 for t in tissues}
    for pair in filter(str.strip, spec.split(",")):
        name, _, weight = pair.partition(":")
        if name.strip() not in out:
            raise ValueError(f"unknown tissue {name.strip()!r}; known: {sorted(out)}")
        out[name.strip()] = float(weight)
    return out


def chemo_expression_score(tpm: Mapping[str, Column], weights: Mapping[str, float], tau: Column, enrichment: Column,
                           specific: Column, lead: str) -> Column:
    """0.4 level + 0.3 specificity + 0.3 enrichment, times 1.75 / 1.5 for specific genes
    whose strongest listed tissue is / is not ``lead``."""
    of = {t: F.coalesce(tpm.get(t, F.lit(0.0)), F.lit(0.0)) for t in weights}
    mean = sum((of[t] * w for t, w in weights.items()), F.lit(0.0)) / sum(weights.values())
    level = F.when(mean > 0, F.least(F.log2(1 + mean) / 7, F.lit(1.0)) * 0.4).otherwise(0.0)
    spec = F.coalesce(F.when(~F.isnan(tau), tau * 0.3), F.lit(0.0))
    enr = F.when(enrichment > 1, F.least(F.log2(enrichment) / 5, F.lit(1.0)) * 0.3).otherwise(0.0)
    rest = [c for t, c in of.items() if t != lead]
    top = F.greatest(*rest) if len(rest) > 1 else rest[0] if rest else F.lit(0.0)
    own = of.get(lead, F.lit(0.0))
    bonus = F.when(~F.coalesce(specific, F.lit(False)), 1.0).when((own > 0) & (own >= top), 1.75).otherwise(1.5)
    return (level + spec + enr) * bonus


def gprotein_score(score: Column, kind: Column, kinds: Sequence[str] = OLFACTORY_PARTNERS) -> Column:
    return F.when(kind.isin(list(kinds)), score * 1.5).otherwise(score)


def ecl_score(ratio: Column, threshold: float = 2.0) -> Column:
    return F.when(ratio >= threshold, F.least(ratio / threshold, F.lit(3.0))).otherwise(ratio / threshold * 0.5)


def expansion_score(p: Column, level: Column, fold: Column, preferred: Sequence[str]) -> Column:
    base = F.when((p > 0) & (p < 1), -F.log10(p)).otherwise(0.0)
    base = F.when(level.isin(list(preferred)), base * 1.5).otherwise(base)
    return F.when(fold > 2, base * F.least(fold / 2, F.lit(2.0))).otherwise(base)


def expression_score(mean: Column, tau: Column, enriched: Column, fold: Column) -> Column:
    bonus = F.when(F.coalesce(enriched, F.lit(False)), 0.3).when(fold > 1.5, 0.1).otherwise(0.0)
    level = F.least(F.log1p(mean) / 10, F.lit(1.0)) * 0.4
    return F.least(level + F.coalesce(tau, F.lit(0.0)) * 0.4 + bonus, F.lit(1.0))


def selection_concordance_boost(score: Column, significant: Column, multi_hit: Column, gene_wide: Column, robust_sites: Column) -> Column:
    first = F.when(significant & multi_hit, 1.3).when(significant & gene_wide, 1.15).otherwise(1.0)
    return score * first * F.when(significant & (robust_sites > 0), 1.1).otherwise(1.0)


def hcr_friendly(length: Column, identity: Column, cluster_size: Column, max_identity: float = 0.8, min_length: int = 600,
                 cluster_limit: int = 5) -> Column:
    """Long enough, no close paralog, no large tandem cluster; unknown identity or
    cluster size does not speak against, unknown length does."""
    return (
        F.coalesce(length >= min_length, F.lit(False))
        & F.coalesce(identity <= max_identity, F.lit(True))
        & F.coalesce(cluster_size < cluster_limit, F.lit(True))
    )


def microswitch_flag(residues: Column, tm_score: Column | None = None, min_tm: float = 0.4) -> Column:
    """1 for Y / F at 6.48 with P at 6.50, 0 otherwise, null where a position is missing
    or the structure alignment is too weak."""
    toggle = F.upper(F.trim(F.try_element_at(residues, F.lit("6.48"))))
    anchor = F.upper(F.trim(F.try_element_at(residues, F.lit("6.50"))))
    flag = F.when(toggle.isNotNull() & anchor.isNotNull(), (toggle.isin("Y", "F") & (anchor == "P")).cast("int"))
    return F.when(tm_score >= min_tm, flag) if tm_score is not None else flag


def _ramp(x: Column, ends: tuple[float, float]) -> Column:
    lo, hi = ends
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (hi - x) / (hi - lo))))


def small_molecule_score(loop_length: Column, pocket_volume: Column) -> Column:
    """Mean of the ramps that can be computed; null when neither input is known."""
    a, b = _ramp(loop_length, LOOP_RANGE), _ramp(pocket_volume, POCKET_RANGE)
    return F.coalesce((a + b) / 2, a, b)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def aa_composition(seq: Column) -> Column:
    """Share of each of the 20 residues among the residues, in alphabetical order."""
    counts = F.array(*[F.regexp_count(seq, F.lit(f"[{a}{a.lower()}]")) for a in AMINO_ACIDS])

    def shares(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0), lambda x, y: x + y)
        return bind(total, lambda n: F.transform(c, lambda k: F.when(n > 0, k / n).otherwise(F.lit(0.0))))

    return bind(counts, shares)


def pairwise_identity(a: Column, b: Column) -> Column:
    """Equal letters over the places where neither aligned row has a gap; rows of
    unequal length are an error."""
    gap = "-."
    hits = F.aggregate(
        F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.isin(*gap) | y.isin(*gap), 0).when(x == y, 2).otherwise(1)),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("m")),
        lambda s, v: F.struct((s["n"] + F.when(v > 0, 1).otherwise(0)).alias("n"), (s["m"] + F.when(v == 2, 1).otherwise(0)).alias("m")),
    )
    share = F.when(hits["n"] > 0, hits["m"] / hits["n"]).otherwise(F.lit(0.0))
    return F.when(F.length(a) == F.length(b), share).otherwise(F.raise_error(F.lit("aligned rows differ in length")).cast("double"))


def windowed_max_identity(a: Column, b: Column, window: int = 300, step: int = 50) -> Column:
    """Largest identity over windows of ``window`` places; shorter rows are one window."""
    n = F.least(F.length(a), F.length(b))
    starts = F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)), F.lit(max(1, step)))
    width = F.least(n, F.lit(window))
    return F.when(n > 0, F.array_max(F.transform(starts, lambda s: pairwise_identity(F.substr(a, s, width), F.substr(b, s, width))))).otherwise(0.0)


def taxid_from_header(header: Column, description: Column) -> Column:
    """OX= number, else a leading ``code_`` part, else OS= word, else the first
    non-numeric ``|`` part, else the start of the header."""
    full = F.concat_ws(" ", header, F.coalesce(description, F.lit("")))

    def hit(pattern: str, text: Column = full) -> Column:
        got = F.regexp_extract(text, pattern, 1)
        return F.when(got != "", got)

    pipe = F.get(F.filter(F.split(header, r"\|"), lambda p: (p != "") & ~p.rlike(r"^\d+$")), F.lit(0))
    return F.coalesce(
        hit(r"OX=(\d+)"), hit(r"^(\d+|[A-Za-z0-9]{2,10})_", header), F.lower(hit(r"OS=([A-Za-z]+)")),
        F.when(header.contains("|"), F.substring(pipe, 1, 10)), F.substring(header, 1, 10),
    )


def species_from_header(header: Column, description: Column) -> Column:
    full = F.concat_ws(" ", header, F.coalesce(description, F.lit("")))
    os_name = F.trim(F.regexp_extract(full, r"OS=([^=]+?)(?:\s+[A-Z]{2}=|$)", 1))
    return F.when(os_name != "", os_name).otherwise(F.trim(F.regexp_extract(full, r"\[([^\]]+)\]", 1)))


def gene_from_header(header: Column, description: Column) -> Column:
    full = F.concat_ws(" ", header, F.coalesce(description, F.lit("")))
    gn = F.regexp_extract(full, r"GN=(\S+)", 1)
    return F.when(gn != "", gn).otherwise(F.regexp_extract(full, r"(?i)gene[=:](\S+)", 1))


def family_regex_classify(protein: Column, genes: Column, rules: Sequence[tuple[str, str]] = FAMILY_RULES,
                          guard: str | None = FAMILY_GUARD, other: str = "") -> Column:
    """First rule that matches the protein name, then the first that matches the gene
    names; a name under the guard belongs to none."""
    def chain(text: Column) -> Column:
        return F.coalesce(*[F.when(text.rlike("(?i)" + p), F.lit(f)) for f, p in rules])

    got = F.coalesce(chain(protein), chain(genes), F.lit(other))
    return F.when(protein.rlike("(?i)" + guard), F.lit(other)).otherwise(got) if guard else got


def class_from_evidence(similarity: Column, domains: Column) -> Column:
    """Class from the curated family statement, else from the first known domain."""
    number = F.regexp_extract(F.coalesce(similarity, F.lit("")), r"(?i)Belongs to the G[- ]?protein[- ]coupled receptor (\d+) family", 1)
    curated = F.create_map(*[F.lit(x) for kv in CLASS_OF_CURATED_FAMILY.items() for x in kv])
    of_domain = F.create_map(*[F.lit(x) for kv in CLASS_OF_DOMAIN.items() for x in kv])
    tokens = F.regexp_extract_all(F.coalesce(domains, F.lit("")), F.lit(r"\bPF\d{5}\b"), F.lit(0))
    known = F.array_compact(F.transform(tokens, lambda x: F.try_element_at(of_domain, x)))
    return F.coalesce(F.try_element_at(curated, number), F.get(known, F.lit(0)), F.lit("UNKNOWN"))


def family_to_class(family: Column) -> Column:
    return F.coalesce(*[F.when(family.startswith(f"class-{c}"), F.lit(c)) for c in "BCF"], F.lit("A"))


def name_asserts_function(name: Column) -> Column:
    """Does an entry's own name commit to a function?"""
    text = F.trim(F.coalesce(name, F.lit("")))
    bare = F.lower(F.trim(F.regexp_replace(text, r"[\s\-_,\.]+", " ")))
    numbered = text.rlike(ABBREVIATION_WITH_NUMBER) & ~text.rlike("(?i)" + FUNCTION_WORD)
    return (text != "") & ~text.rlike("(?i)" + UNCHARACTERIZED) & ~text.rlike("(?i)" + PLACEHOLDER) & ~numbered & ~bare.isin(*BARE_LABELS)


def codon_table() -> dict[str, str]:
    """The standard code, built from its published T-C-A-G order."""
    it = iter(CODON_AMINO_ACIDS)
    return {a + b + c: next(it) for a in CODON_ORDER for b in CODON_ORDER for c in CODON_ORDER}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgtNn", "TGCAtgcaNn"))


def codons(seq: Column) -> Column:
    text = F.upper(seq)
    return F.regexp_extract_all(text, F.lit("(?s)..."), F.lit(0))


def translate_cds(seq: Column) -> Column:
    """Amino acids of whole codons (X for unknown ones), without the trailing stops."""
    table = F.create_map(*[F.lit(x) for kv in codon_table().items() for x in kv])
    return F.rtrim(F.array_join(F.transform(codons(seq), lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), ""), F.lit("*"))


def splice_cds(chrom_seq: Column, exons: Column, strand: Column) -> Column:
    """Exons (structs start, end; one-based, inclusive) cut from the chromosome in
    order, turned on the minus strand and trimmed to whole codons; null where shorter
    than nine letters or with a stop before the last codon."""
    parts = F.transform(F.array_sort(exons), lambda e: F.substr(chrom_seq, e["start"], e["end"] - e["start"] + 1))
    joined = F.array_join(parts, "")
    cds = F.when(strand == "-", reverse_complement(joined)).otherwise(joined)
    cds = F.substr(cds, F.lit(1), (F.floor(F.length(cds) / 3) * 3).cast("int"))
    inner = F.slice(codons(cds), F.lit(1), F.greatest(F.floor(F.length(cds) / 3).cast("int") - 1, F.lit(0)))
    stops = F.exists(inner, lambda c: c.isin("TAA", "TAG", "TGA"))
    return F.when((F.length(joined) >= 9) & ~stops, cds)


def file_name_fields(name: Column) -> tuple[Column, Column]:
    """(taxid, binomial) of ``<taxid>_<Genus>_<species>.<ext>``; null where it does not match."""
    base = F.element_at(F.split(name, "/"), -1)
    stem = F.when(base.rlike(FASTA_SUFFIXES), F.regexp_replace(base, FASTA_SUFFIXES, "")).otherwise(F.regexp_replace(base, r"\.[^.]+$", ""))
    taxid = F.regexp_extract(stem, r"^(\d+)_(.+)$", 1).try_cast("long")
    binomial = F.trim(F.replace(F.regexp_extract(stem, r"^(\d+)_(.+)$", 2), F.lit("_"), F.lit(" ")))
    return F.when(binomial != "", taxid), F.when(binomial != "", binomial)


def namespace_ids(leaf: Column, seq_id: Column, separator: str = "|") -> Column:
    return F.concat_ws(separator, leaf, seq_id)


def sanitize_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(name), "[^A-Za-z0-9_]+", "_"), "_+", "_"), "^_|_$", "")


def base_accession(accession: Column) -> Column:
    return F.split_part(F.trim(F.coalesce(accession, F.lit(""))), F.lit("."), F.lit(1))


def structure_stem(name: Column, depth: int = 3) -> Column:
    """File name without directories and (nested) structure extensions."""
    out = F.element_at(F.split(F.trim(name), "/"), -1)
    for _ in range(depth):
        out = F.regexp_replace(out, STRUCTURE_SUFFIXES, "")
    return out


def target_keys(target: Column) -> Column:
    """Lookup keys of a structure-search target, most literal first."""
    raw = F.trim(target)
    stem = structure_stem(target)
    model = F.regexp_extract(stem, r"^AF-([A-Za-z0-9]+)-F\d+-model_v\d+(?:_[A-Za-z0-9]{1,4})?$", 1)
    entry = F.regexp_extract(stem, r"^(\d[A-Za-z0-9]{3})_([A-Za-z0-9]{1,4})$", 1)
    chain = F.regexp_extract(stem, r"^(\d[A-Za-z0-9]{3})_([A-Za-z0-9]{1,4})$", 2)
    some = (model == "") & (entry != "")
    keys = F.array(
        raw, F.element_at(F.split(raw, "/"), -1), stem, F.when(model != "", model),
        F.when(some, entry), F.when(some, F.lower(entry)), F.when(some, F.upper(entry)),
        F.when(some, F.concat_ws("_", F.lower(entry), chain)), F.when(some, F.concat_ws("_", F.upper(entry), chain)),
    )
    return F.filter(F.array_distinct(keys), lambda k: k.isNotNull() & (k != ""))


def query_keys(name: Column) -> Column:
    """Lookup keys of a structure-search query: as written, without extension, without chain."""
    raw, stem = F.trim(name), structure_stem(name)
    chainless = F.regexp_extract(stem, r"^(.+)_([A-Za-z0-9]{1,4})$", 1)
    keys = F.array(raw, F.element_at(F.split(raw, "/"), -1), stem, F.when(chainless != "", chainless))
    return F.filter(F.array_distinct(keys), lambda k: k.isNotNull() & (k != ""))


def id_canonicalize(df: DataFrame, raw: str, universe: DataFrame, id_col: str, keys=query_keys) -> DataFrame:
    """``df`` plus ``canonical``: the first lookup key that is an id of ``universe``."""
    asked = df.select(raw).distinct().select(raw, F.posexplode(keys(F.col(raw))).alias("pos", "key"))
    hit = asked.join(universe.select(F.col(id_col).alias("key")).distinct(), "key")
    best = hit.groupBy(raw).agg(F.min_by("key", "pos").alias("canonical"))
    return df.join(best, raw, "left")


def reliability_flag(n: Column) -> Column:
    return F.when(n >= 10, "high").when(n >= 5, "medium").otherwise("low")


def source_is_dark(evidence: Column, source: str) -> Column:
    said = F.regexp_extract(F.concat(F.lit(";"), F.coalesce(evidence, F.lit(""))), rf";\s*{source}\s*:([^;]*)", 1)
    return F.lower(F.trim(said)).isin(*DARK_LABELS)


def needs_manual_review(classification: Column, evidence: Column) -> Column:
    """Yes for a default candidate whose two annotation sources said nothing."""
    return F.when(
        (classification == "chemoreceptor-candidate") & source_is_dark(evidence, "hmm") & source_is_dark(evidence, "og"), "yes"
    ).otherwise("no")


def exclusion_power(n: Column, rate: Column) -> Column:
    return 1.0 - F.pow(1.0 - rate, n)


def effective_size(n: Column, correlation: Column) -> Column:
    return F.when(n <= 1, n.cast("double")).otherwise(n / (1.0 + (n - 1) * correlation))


def assembly_level_rank(level: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in ASSEMBLY_LEVELS.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, F.coalesce(level, F.lit(""))), F.lit(0))


def assembly_level_filter(level: Column, minimum: str) -> Column:
    return assembly_level_rank(level) >= ASSEMBLY_LEVELS.get(minimum, 0)


def gap_fraction(seq: Column) -> Column:
    return F.when(F.length(seq) > 0, (F.length(seq) - F.length(F.translate(seq, "-", ""))) / F.length(seq)).otherwise(1.0)


def shuffle_residues(seq: Column, fraction: float, *key: Column | str | int) -> Column:
    """Permutes the letters at a random ``fraction`` of the places; length and letters
    stay the same.  The draw is seeded by a hash of ``key``, so a repeated task gives
    the same text."""

    @F.pandas_udf(T.StringType())
    def shuffled(text: pd.Series, seed: pd.Series) -> pd.Series:
        def one(value, start):
            if value is None:
                return None
            picked = int(round(fraction * len(value)))
            if picked < 2:
                return value
            rng = np.random.default_rng(int(start) & 0xFFFFFFFFFFFFFFFF)
            letters = np.array(list(value))
            places = rng.choice(len(letters), size=picked, replace=False)
            letters[np.sort(places)] = letters[places]
            return "".join(letters)

        return pd.Series([one(v, s) for v, s in zip(text, seed)], index=text.index)

    return shuffled(seq, F.xxhash64(*[x if isinstance(x, Column) else F.lit(str(x)) for x in key]))
