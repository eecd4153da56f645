"""Genomic intervals, runs and loci as ordered scans.

Intervals are half open.  Overlap questions are answered with running aggregates over
sorted ends or with fixed-width bins, so a crowded chromosome is spread over many
tasks and overlapping rows are not paired with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.joins import split_hot
from evidara.ordering import Scan, row_numbers, running
from evidara.session import cut

#: placements of one query that are compared as a list
LIST_ROWS = 1000
#: rows of one query that one task orders
TASK_ROWS = 100_000


def interval_loci(df: DataFrame, keys: Sequence[str], id_col: str, start: str = "start", end: str = "end",
                  name: str = "locus") -> DataFrame:
    """``df`` plus the number of its locus inside ``keys``: a row joins the locus while
    it starts before the largest end seen so far (touching ends stay apart)."""
    keys = list(keys)
    got = running(df, keys, [start, end, id_col], {"__reach": Scan("max", F.col(end))})
    opens = F.when(F.col("__reach").isNull() | (F.col(start) >= F.col("__reach")), 1).otherwise(0)
    got = running(got.withColumn("__open", opens), keys, [start, end, id_col], {name: Scan("sum", F.col("__open"), "upto")})
    return got.drop("__reach", "__open").withColumn(name, F.col(name).cast("long"))


def tandem_clusters(df: DataFrame, scaffold: str, id_col: str, window: float, min_size: int, start: str = "start",
                    end: str = "end") -> DataFrame:
    """(id, size, cluster): rows chain while the next start lies at most ``window``
    behind the previous row's own end; short chains count as isolated.  Clusters are
    numbered along the scaffold."""
    order = [start, id_col]
    last = Scan("max", F.struct(start, id_col, F.col(end).alias("e")))
    got = running(df.select(id_col, scaffold, start, end), [scaffold], order, {"__prev": last})
    opens = F.when(F.col("__prev").isNull() | (F.col(start) - F.col("__prev.e") > window), 1).otherwise(0)
    got = cut(running(got.withColumn("__open", opens).drop("__prev"), [scaffold], order, {"chain": Scan("sum", F.col("__open"), "upto")}))
    sizes = got.groupBy(scaffold, "chain").agg(F.count("*").alias("size")).where(F.col("size") >= min_size)
    named = row_numbers(sizes, [scaffold], ["chain"], "k")
    label = F.concat(F.col(scaffold).cast("string"), F.lit(":cluster_"), F.col("k").cast("string"))
    return got.join(named.select(scaffold, "chain", "size", label.alias("cluster")), [scaffold, "chain"], "left").select(
        id_col, F.coalesce("size", F.lit(1)).alias("size"), "cluster"
    )


def overlap_counts(members: DataFrame, genes: DataFrame, keys: Sequence[str], id_col: str, start: str = "start",
                   end: str = "end") -> DataFrame:
    """(id, n_overlaps): how many distinct gene intervals each member overlaps =
    genes that start before its end minus genes that end at or before its start.
    No pair of intervals is formed."""
    keys = list(keys)
    g = genes.select(*keys, start, end).distinct()
    m = cut(members.select(*keys, id_col, start, end))
    # kind orders equal places: ends close before a member starts, starts open after it ends
    marks = (
        g.select(*keys, F.col(end).alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("s"), F.lit(1).alias("e"))
        .unionByName(g.select(*keys, F.col(start).alias("at"), F.lit(2).alias("kind"), F.lit(1).alias("s"), F.lit(0).alias("e")))
        .unionByName(m.select(*keys, F.col(start).alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("s"), F.lit(0).alias("e")))
        .unionByName(m.select(*keys, F.col(end).alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("s"), F.lit(0).alias("e")))
    )
    marks = marks.groupBy(*keys, "at", "kind").agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    got = running(marks, keys, ["at", "kind"], {"opened": Scan("sum", F.col("s"), "upto"), "closed": Scan("sum", F.col("e"), "upto")})
    got = cut(got.where("kind = 1").select(*keys, "at", "opened", "closed"))
    at_end = got.select(*keys, F.col("at").alias(end), "opened")
    at_start = got.select(*keys, F.col("at").alias(start), "closed")
    return m.join(at_end, [*keys, end]).join(at_start, [*keys, start]).select(
        id_col, (F.col("opened") - F.col("closed")).alias("n_overlaps")
    )


def with_bins(df: DataFrame, width: int, start: str = "start", end: str = "end") -> DataFrame:
    """One row per bin the interval touches."""
    return df.withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.greatest(F.col(end) - 1, F.col(start))) / width)))
    )


def concordant_placements(a: DataFrame, b: DataFrame, min_identity: float, min_coverage: float, width: int) -> DataFrame:
    """Placements (query, chrom, start, end, strand, identity, coverage, method) that
    two methods agree on: both pass the gates and overlap; the one with the higher
    identity speaks (``a`` on a tie).

    A query's placements meet as one short list.  Queries that may have more than ``LIST_ROWS`` of them meet
    by semi joins over bins: no pair leaves the join."""
    gate = (F.col("identity") >= min_identity) & (F.col("coverage") >= min_coverage)
    keys, cols = ["query", "chrom", "strand"], a.columns
    # a missing key agrees with none
    known = gate & F.col("query").isNotNull() & F.col("chrom").isNotNull() & F.col("strand").isNotNull()
    both = cut(a.where(known).withColumn("__first", F.lit(True)).unionByName(b.where(known).withColumn("__first", F.lit(False))))
    few, many = split_hot(both, ["query"], LIST_ROWS)

    def agrees(x: Column, y: Column) -> Column:
        wins = F.when(x["__first"], x["identity"] >= y["identity"]).otherwise(x["identity"] > y["identity"])
        return ((x["__first"] != y["__first"]) & (x["chrom"] == y["chrom"]) & (x["strand"] == y["strand"])
                & (x["start"] < y["end"]) & (y["start"] < x["end"]) & wins)

    rest = [c for c in cols if c != "query"]
    lists = few.groupBy("query").agg(F.collect_set(F.struct(*rest, "__first")).alias("__all"))
    said = F.filter("__all", lambda x: F.exists("__all", lambda y: agrees(x, y)))
    got = lists.select("query", F.explode(F.array_distinct(F.transform(said, lambda x: F.struct(*[x[c].alias(c) for c in rest])))).alias("x"))
    got = got.select("query", "x.*").select(*cols)
    if many is None:
        return got
    a, b = cut(many.where("__first").drop("__first")), cut(many.where("NOT __first").drop("__first"))

    def agreed(x: DataFrame, y: DataFrame, wins: Column) -> DataFrame:
        xs = with_bins(x, width).alias("x")
        ys = with_bins(y.select(*keys, "start", "end", "identity"), width).alias("y")
        same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys] + [F.col("x.bin") == F.col("y.bin")]
        touch = (F.col("x.start") < F.col("y.end")) & (F.col("y.start") < F.col("x.end"))
        on = same[0]
        for s in same[1:]:
            on = on & s
        return xs.join(ys, on & touch & wins, "left_semi").drop("bin").distinct()

    more = agreed(a, b, F.col("x.identity") >= F.col("y.identity")).unionByName(
        agreed(b, a, F.col("x.identity") > F.col("y.identity"))
    ).distinct()
    return got.unionByName(more)


_BEST_FIRST = ("chrom", "start", "end", "strand", "method")


def best_and_margin(placements: DataFrame, id_col: str | None = None) -> DataFrame:
    """Per query the best placement over distinct loci, its identity margin over the
    next locus (infinite when alone) and the number of loci.

    A query's placements are ordered in one task, all steps after a single shuffle; queries that may have more than
    ``TASK_ROWS`` of them are cut into ranges."""
    rows = placements if id_col else placements.withColumn("__id", F.xxhash64(*placements.columns))
    keys = ["query", "chrom", "strand"]
    few, many = split_hot(cut(rows.where(F.col("query").isNotNull())), ["query"], TASK_ROWS)
    rest = [c for c in placements.columns if c not in ("query",)]
    first = F.struct((-F.col("identity")).alias("i"), *_BEST_FIRST)

    def picked(loci: DataFrame) -> DataFrame:
        rep = loci.groupBy(*keys, "locus").agg(F.min_by(F.struct(*rest), first).alias("r")).select("query", F.col("r.*"))
        order = Window.partitionBy("query").orderBy(F.col("identity").desc(), *_BEST_FIRST)
        two = rep.withColumn("rn", F.row_number().over(order)).withColumn("n_loci", F.count("*").over(Window.partitionBy("query")))
        best = two.where("rn <= 2").groupBy("query").agg(
            F.min_by(F.struct(*rest), "rn").alias("b"), F.max(F.when(F.col("rn") == 2, F.col("identity"))).alias("second"), F.max("n_loci").alias("n_loci")
        )
        return best.select(
            "query", F.col("b.*"),
            F.coalesce(F.col("b.identity") - F.col("second"), F.lit(float("inf"))).alias("margin"), "n_loci",
        )

    order = Window.partitionBy(*keys).orderBy("start", "end", id_col or "__id")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("__reach").isNull() | (F.col("start") >= F.col("__reach")), 1).otherwise(0)
    loci = few.repartition("query").withColumn("__reach", reach).withColumn("__open", opens)
    got = picked(loci.withColumn("locus", F.sum("__open").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    return got if many is None else got.unionByName(picked(interval_loci(many, keys, id_col or "__id")))


def placement_cascade(queries: DataFrame, minimap: DataFrame, gmap: DataFrame, protein: DataFrame, reciprocal: DataFrame,
                      min_identity: float, min_coverage: float, min_margin: float, width: int) -> DataFrame:
    """One placement per query from the first method that places it without doubt:
    agreeing spliced alignments, protein-to-genome, reciprocal hit, else unplaced."""
    gate = (F.col("identity") >= min_identity) & (F.col("coverage") >= min_coverage)
    steps = [
        ("minimap2+gmap_concordant", "high", concordant_placements(minimap, gmap, min_identity, min_coverage, width)),
        ("miniprot", "medium", protein.where(gate)),
        ("rbh", "low", reciprocal.where(gate)),
    ]
    tagged = None
    for i, (_, _, df) in enumerate(steps):
        # the step is part of the query key, so all three steps share one pass
        part = df.withColumn("query", F.struct(F.col("query").alias("q"), F.lit(i).alias("step")))
        tagged = part if tagged is None else tagged.unionByName(part)
    got = best_and_margin(tagged).where((F.col("n_loci") == 1) | (F.col("margin") >= min_margin))
    pick = got.groupBy(F.col("query.q").alias("query")).agg(
        F.min_by(F.struct("chrom", "start", "end", "strand", "identity", "coverage", F.col("query.step").alias("step"), "margin", "n_loci"),
                 F.col("query.step")).alias("p")
    )
    names, levels = (F.array(*[F.lit(s[i]) for s in steps]) for i in (0, 1))
    return queries.select("query").join(pick, "query", "left").select(
        "query", F.col("p.chrom").alias("chrom"), F.col("p.start").alias("start"), F.col("p.end").alias("end"),
        F.col("p.strand").alias("strand"), F.col("p.identity").alias("identity"), F.col("p.coverage").alias("coverage"),
        F.coalesce(F.get(names, F.col("p.step")), F.lit("unplaced")).alias("method"), F.coalesce(F.get(levels, F.col("p.step")), F.lit("none")).alias("confidence"),
        F.col("p.margin").alias("margin"), F.coalesce(F.col("p.n_loci") >= 2, F.lit(False)).alias("multi_mapping"),
    )


def representative_order() -> list[Column]:
    """Complete before partial, then longest, genome before transcriptome, then id."""
    return [(~F.col("complete")).alias("a"), (-F.col("length")).alias("b"), (F.col("source") != "genome").alias("c"), F.col("query").alias("d")]


def reconcile_genes(models: DataFrame, genes: DataFrame | None = None, low_margin: float = 2.0,
                    disagreement: float = 0.2) -> DataFrame:
    """One row per locus of ``models`` (query, chrom, start, end, strand, source,
    complete, length, margin?, multi_mapping?): span, representative, provenance and
    sorted quality flags."""
    cols = models.columns
    m = models if "margin" in cols else models.withColumn("margin", F.lit(None).cast("double"))
    m = m if "multi_mapping" in cols else m.withColumn("multi_mapping", F.lit(False))
    keys = ["chrom", "strand"]
    if genes is not None:
        hits = overlap_counts(m, genes, keys, "query")
        m = m.join(hits, "query", "left")
    else:
        m = m.withColumn("n_overlaps", F.lit(0))
    loci = interval_loci(m, keys, "query")
    first = F.struct(*representative_order())
    is_genome, is_txome = F.col("source") == "genome", F.col("source") == "txome"
    g = loci.groupBy(*keys, "locus").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_members"),
        F.min_by(F.struct("query", "length", "margin", "multi_mapping"), first).alias("rep"),
        F.min_by(F.when(is_genome, F.col("length")), F.when(is_genome, first)).alias("gl"),
        F.min_by(F.when(is_txome, F.col("length")), F.when(is_txome, first)).alias("tl"),
        F.max(is_genome).alias("has_genome"), F.max(is_txome).alias("has_txome"), F.max("complete").alias("any_complete"),
        F.max(F.coalesce("n_overlaps", F.lit(0))).alias("most_genes"),
    )
    both = F.col("has_genome") & F.col("has_txome")
    longer = F.greatest("gl", "tl")
    apart = both & (longer > 0) & (F.abs(F.col("gl") - F.col("tl")) / longer > disagreement)
    flags = F.array_sort(F.array_compact(F.array(
        F.when(F.col("most_genes") >= 2, "chimeric"), F.when(~F.col("any_complete"), "partial_only"),
        F.when(apart, "source_disagreement"), F.when(F.col("rep.margin") < low_margin, "low_margin"),
        F.when(F.col("rep.multi_mapping"), "multi_mapping"),
    )))
    return g.select(
        *keys, "locus", "start", "end", "n_members", F.col("rep.query").alias("representative"),
        F.when(both, "both").when(F.col("has_genome"), "genome_only").otherwise("transcriptome_only").alias("provenance"),
        F.array_join(flags, ",").alias("qc_flags"),
    )


def greedy_locus_claim(models: DataFrame, chrom: str, id_col: str, score: str, fraction: float, width: int,
                       start: str = "start", end: str = "end") -> DataFrame:
    """(id, kept): best score first, keep a model unless it covers ``fraction`` of the
    shorter span with a kept one (inclusive ends).

    Rounds: a model that leads every bin it touches cannot lose any more and is kept;
    whatever conflicts with a kept one leaves.  In a bin at most one model is kept per
    round, so the conflict join meets one row per bin, not all pairs.  Rounds go on
    until nothing is open.
    """
    rank = F.struct((-F.col(score)).alias("s"), F.col(id_col).alias("i"))
    # closed ends and a shared base are needed for any conflict, so conflicts share a bin
    base = models.select(id_col, chrom, start, end, score)
    bins = F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))
    open_rows = cut(base.withColumn("rank", rank))
    decided = None
    while not open_rows.isEmpty():
        cells = open_rows.withColumn("bin", F.explode(bins))
        lead = cells.groupBy(chrom, "bin").agg(F.min("rank").alias("lead"))
        judged = cells.join(lead, [chrom, "bin"]).groupBy(id_col).agg(F.min(F.col("rank") == F.col("lead")).alias("leads"))
        state = open_rows.join(judged, id_col)
        kept = cut(state.where("leads").drop("leads"))
        k = kept.withColumn("bin", F.explode(bins)).select(
            chrom, "bin", F.col(start).alias("ks"), F.col(end).alias("ke"))
        shared = F.least(F.col(end), F.col("ke")) - F.greatest(F.col(start), F.col("ks")) + 1
        shorter = F.least(F.col(end) - F.col(start), F.col("ke") - F.col("ks")) + 1
        rest = cut(state.where(~F.col("leads")).drop("leads"))
        lost = cut(
            rest.withColumn("bin", F.explode(bins)).join(k, [chrom, "bin"])
            .where(F.greatest(shared, F.lit(0)) / shorter >= fraction).select(id_col).distinct()
        )
        verdict = kept.select(id_col, F.lit(True).alias("kept")).unionByName(lost.select(id_col, F.lit(False).alias("kept")))
        decided = verdict if decided is None else cut(decided.unionByName(verdict))
        open_rows = cut(rest.join(lost, id_col, "left_anti"))
    return decided if decided is not None else base.select(id_col, F.lit(True).alias("kept")).limit(0)


def topology_runs(df: DataFrame, id_col: str, topology: str) -> DataFrame:
    """(id, kind, start, end): runs of M / O / I labels, one-based inclusive; other
    characters belong to the run they follow.  One row in, no shuffle."""
    text = F.translate(F.col(topology), "moi", "MOI")
    runs = F.regexp_extract_all(text, F.lit("M[^OI]*|O[^MI]*|I[^MO]*"), F.lit(0))
    skipped = F.length(F.regexp_extract(text, "^[^MOI]*", 0))
    ends = F.aggregate(
        F.transform(runs, lambda r: F.length(r)), F.array().cast("array<int>"),
        lambda acc, n: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), skipped) + n)),
    )
    got = df.select(id_col, F.explode(F.arrays_zip(runs.alias("r"), ends.alias("e"))).alias("x"))
    letter = F.substring(F.col("x.r"), 1, 1)
    kind = F.when(letter == "M", "tm").when(letter == "O", "ecl").otherwise("icl")
    return got.select(id_col, kind.alias("kind"), (F.col("x.e") - F.length("x.r") + 1).alias("start"), F.col("x.e").alias("end"))


# Published hydropathy of the residues.
HYDROPATHY = {
    "A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "Q": -3.5, "E": -3.5, "G": -0.4, "H": -3.2, "I": 4.5,
    "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2,
}


def hydropathy_segments(df: DataFrame, id_col: str, seq: str, window: int = 21, threshold: float = 1.6, min_gap: int = 8) -> DataFrame:
    """(id, start, end): zero-based half-open stretches whose ``window`` mean reaches
    ``threshold``; windows that touch merge, stretches closer than ``min_gap`` too.

    The windows of one sequence are one array operation; exploding characters would
    shuffle a row per letter.
    """
    table = np.zeros(65536)
    for c, v in HYDROPATHY.items():
        table[ord(c)] = table[ord(c.lower())] = v
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def scan(batches):
        for pdf in batches:
            ids, lo, hi = [], [], []
            for key, text in zip(pdf[id_col], pdf[seq]):
                if text is None or len(text) < window:
                    continue
                codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
                sums = np.cumsum(np.concatenate([[0], np.rint(table[np.minimum(codes, 65535)] * 10).astype(np.int64)]))
                hits = np.flatnonzero((sums[window:] - sums[:-window]) >= round(threshold * window * 10, 6))
                if not hits.size:
                    continue
                # windows merge while they touch or leave less than min_gap letters
                far = np.flatnonzero(np.diff(hits) > window + max(min_gap, 1) - 1)
                first, last = np.concatenate([[0], far + 1]), np.concatenate([far, [hits.size - 1]])
                lo.extend(hits[first]); hi.extend(hits[last] + window); ids.extend([key] * len(first))
            yield pd.DataFrame({id_col: ids, "start": np.array(lo, dtype="int64"), "end": np.array(hi, dtype="int64")})

    return df.select(id_col, seq).mapInPandas(scan, schema)


def sliding_mean(df: DataFrame, keys: Sequence[str], pos: str, value: str, window: int, block: int = 4096) -> DataFrame:
    """(keys, pos, mean): mean of ``value`` over pos .. pos + window - 1 where the whole
    window exists.  Long tracks are cut into blocks that carry a margin of
    ``window - 1`` rows, so no track is one task."""
    keys = list(keys)
    home = F.floor(F.col(pos) / block)
    rows = df.select(*keys, pos, value, F.explode(F.array_distinct(F.array(home, F.floor((F.col(pos) - window + 1) / block)))).alias("block"), home.alias("home"))
    w = Window.partitionBy(*keys, "block").orderBy(pos).rowsBetween(0, window - 1)
    got = rows.select("*", F.avg(value).over(w).alias("mean"), F.count("*").over(w).alias("n"))
    return got.where((F.col("home") == F.col("block")) & (F.col("n") == window)).select(*keys, pos, "mean")


def conserved_regions(df: DataFrame, keys: Sequence[str], pos: str, value: str, window: int = 10, threshold: float = 0.7,
                      digits: int = 9) -> DataFrame:
    """(keys, start, end, length, mean): stretches opened where the forward mean reaches
    ``threshold`` and closed at the next failing window, ending one short of that
    window's last place (or at the last position).  Positions are 1..n."""
    keys = list(keys)
    means = sliding_mean(df, keys, pos, value, window).withColumn("ok", (F.round("mean", digits) >= threshold).cast("int"))
    flagged = running(means, keys, [pos], {"seen": Scan("sum", F.col("ok"), "upto")}).where("ok = 1")
    spans = flagged.groupBy(*keys, (F.col(pos) - F.col("seen")).alias("island")).agg(F.min(pos).alias("a"), F.max(pos).alias("b"))
    n = df.groupBy(*keys).agg(F.max(pos).alias("n"))
    spans = spans.join(n, keys).select(
        *keys, F.col("a").alias("start"),
        F.when(F.col("b") == F.col("n") - window + 1, F.col("n")).otherwise(F.col("b") + window - 1).alias("end"),
    )
    total = cut(running(df.select(*keys, pos, value), keys, [pos], {"t": Scan("sum", F.col(value), "upto"), "p": Scan("sum", F.col(value))}))
    upto = total.select(*keys, F.col(pos).alias("end"), "t")
    before = total.select(*keys, F.col(pos).alias("start"), F.coalesce("p", F.lit(0.0)).alias("p"))
    length = F.col("end") - F.col("start") + 1
    return spans.join(upto, [*keys, "end"]).join(before, [*keys, "start"]).select(
        *keys, "start", "end", length.alias("length"), ((F.col("t") - F.col("p")) / length).alias("mean")
    )


def map_columns(cols: DataFrame, key: str) -> DataFrame:
    """(key, strict_site, lenient_site): each strict column takes the next lenient
    column with the same content, in order.  ``cols``: key, kind, site, content (a
    hash); a group is one alignment's column hashes, not its cells."""
    id_type = cols.schema[key].dataType
    schema = T.StructType([T.StructField(key, id_type), T.StructField("strict_site", T.LongType()), T.StructField("lenient_site", T.LongType())])

    def walk(name, pdf):
        pdf = pdf.sort_values("site")
        strict, lenient = pdf[pdf.kind == "strict"], pdf[pdf.kind == "lenient"]
        where: dict = {}
        for site, content in zip(lenient.site, lenient.content):
            where.setdefault(content, []).append(site)
        out, front = [], 0
        for content in strict.content:
            sites = where.get(content, [])
            at = np.searchsorted(sites, front, side="right")
            if at < len(sites):
                front = sites[at]
                out.append(front)
            else:
                # an unmatched column uses up the rest of the alignment
                front = np.inf
                out.append(None)
        return pd.DataFrame({key: name[0], "strict_site": strict.site.to_numpy(), "lenient_site": pd.array(out, dtype="Int64")})

    return cols.groupBy(key).applyInPandas(walk, schema)


def site_concordance(mapping: DataFrame, strict: DataFrame, lenient: DataFrame, key: str) -> DataFrame:
    """Per group: sites found under both alignments, under one only, and the share.
    ``strict`` / ``lenient``: (key, site) of the significant sites."""
    s = strict.join(mapping.select(key, F.col("strict_site").alias("site"), "lenient_site"), [key, "site"], "left")
    both = s.select(key, F.col("lenient_site").alias("site"), F.lit(1).alias("in_s")).join(
        lenient.select(key, "site", F.lit(1).alias("in_l")), [key, "site"], "full")
    return both.groupBy(key).agg(
        F.count("in_s").alias("n_strict_positive_sites"), F.count("in_l").alias("n_lenient_positive_sites"),
        F.count_if(F.col("in_s").isNotNull() & F.col("in_l").isNotNull()).alias("high_confidence_sites_n"),
        F.count_if(F.col("in_s").isNull()).alias("lenient_only_sites_n"),
        F.count_if(F.col("in_l").isNull()).alias("strict_only_sites_n"),
    ).withColumn("alignment_robustness_index", F.when(
        F.col("n_lenient_positive_sites") > 0, F.round(F.col("high_confidence_sites_n") / F.col("n_lenient_positive_sites"), 6)).otherwise(0.0))
