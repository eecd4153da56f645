"""Orders against orders: overlap, shifts, ablation, perturbed weights, batches."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.operators import fusion as fu
from evidara.operators.stats import kendall_tau, scenarios, uniform
from evidara.ordering import percentiles, ranked, row_numbers
from evidara.session import cut


def both_places(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, id, pa, pb): one-based places of each id in the two orders."""
    keys = list(keys)
    return a.select(*keys, "id", F.col("place").alias("pa")).join(
        b.select(*keys, "id", F.col("place").alias("pb")), [*keys, "id"], "full"
    )


def topk_overlap(places: DataFrame, ks: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, k, n_both, jaccard, overlap, n_entered) for every k."""
    rows = places.select(*keys, "pa", "pb", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    in_a, in_b = F.coalesce(F.col("pa") <= F.col("k"), F.lit(False)), F.coalesce(F.col("pb") <= F.col("k"), F.lit(False))
    s = rows.groupBy(*keys, "k").agg(
        F.count_if(in_a & in_b).alias("n_both"), F.count_if(in_a | in_b).alias("n_any"),
        F.count_if(in_b & ~in_a).alias("n_entered"), F.count("pa").alias("la"), F.count("pb").alias("lb"),
    )
    return s.select(
        *keys, "k", "n_both", F.when(F.col("n_any") > 0, F.col("n_both") / F.col("n_any")).otherwise(1.0).alias("jaccard"),
        (F.col("n_both") / F.least("k", "la", "lb")).alias("overlap"), "n_entered",
    )


def median_shift(places: DataFrame, n: int) -> DataFrame:
    """One row (shift): median move of the first n of a; an id missing from b counts as
    one place past its end."""
    end = places.agg(F.count("pb").alias("v")).scalar()
    rows = places.where(F.col("pa") <= n).select("pa", "pb", end.alias("e"))
    rows = rows.select(F.abs(F.col("pa") - F.coalesce("pb", F.col("e") + 1)).cast("double").alias("s"))
    return percentiles(rows, [], "s", {"shift": 0.5}).select("shift")


def topk_movement(places: DataFrame, k: int) -> DataFrame:
    """(id, pa, pb, move) for every id in either top k, by size of move."""
    ends = places.agg(F.count("pa").alias("ea"), F.count("pb").alias("eb"))
    rows = places.where((F.coalesce("pa", F.lit(k + 1)) <= k) | (F.coalesce("pb", F.lit(k + 1)) <= k))
    rows = rows.select("id", "pa", "pb", ends.select("ea").scalar().alias("ea"), ends.select("eb").scalar().alias("eb"))
    rows = rows.select("id", F.coalesce("pa", F.col("ea") + 1).alias("pa"), F.coalesce("pb", F.col("eb") + 1).alias("pb"),
                       F.when(F.col("pa").isNull() | (F.col("pa") > k), "entered")
                       .when(F.col("pb").isNull() | (F.col("pb") > k), "left").otherwise("stayed").alias("state"))
    return rows.withColumn("move", F.abs(F.col("pa") - F.col("pb")))


def compare_orders(a: DataFrame, b: DataFrame, ns: Sequence[int]) -> DataFrame:
    """(n, n_common, spearman, kendall, jaccard, median_shift) at several depths."""
    places = cut(both_places(a, b))
    common = cut(places.where(F.col("pa").isNotNull() & F.col("pb").isNotNull()))
    # places among the common ids: gaps left by others do not change either rank order
    ca = row_numbers(common, [], ["pa"], "ra")
    cb = row_numbers(ca, [], ["pb"], "rb")
    rho = cut(cb.agg(F.corr("ra", "rb").alias("rho"), F.count("*").alias("n")))
    tau = kendall_tau(common, "pa", "pb").select("tau").scalar()
    top = topk_overlap(places, ns).select("k", "jaccard")
    out = None
    for n in ns:
        row = median_shift(places, n).select(F.lit(n).alias("k"), "shift")
        out = row if out is None else out.unionByName(row)
    return top.join(out, "k").select(
        F.col("k").alias("n"), rho.select("n").scalar().alias("n_common"), rho.select("rho").scalar().alias("spearman"),
        tau.alias("kendall"), "jaccard", F.col("shift").alias("median_shift"),
    )


def recall_curve(order: DataFrame, truth: DataFrame, ns: Sequence[int]) -> DataFrame:
    """(n, recall, precision, n_truth_total, n_truth_found, mean_rank)."""
    t = truth.select("id").distinct()
    total = t.agg(F.count("*").alias("v")).scalar()
    length = order.agg(F.count("*").alias("v")).scalar()
    hits = order.join(t, "id", "left_semi").select("place")
    mean = hits.agg(F.avg("place").alias("v")).scalar()
    grid = order.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in ns])).alias("n"))
    found = hits.select("place", F.explode(F.array(*[F.lit(n) for n in ns])).alias("n")).where("place <= n")
    found = found.groupBy("n").agg(F.count("*").alias("f"))
    rows = grid.join(found, "n", "left").select("n", F.coalesce("f", F.lit(0)).alias("f"), total.alias("t"), length.alias("l"), mean.alias("mr"))
    depth = F.least("n", "l")
    return rows.select(
        "n", F.when(F.col("t") > 0, F.col("f") / F.col("t")).otherwise(0.0).alias("recall"),
        F.when(depth > 0, F.col("f") / depth).otherwise(0.0).alias("precision"),
        F.col("t").alias("n_truth_total"), F.col("f").alias("n_truth_found"), F.col("mr").alias("mean_rank"),
    )


def ablation(df: DataFrame, weights: Mapping[str, float], drops: Mapping[str, Sequence[str]], k: int,
             fill: Mapping[str, float] | None = None, digits: int = 9) -> DataFrame:
    """(name, spearman, jaccard, n_moved_in) per dropped signal group, and for
    ``missingness``: unmeasured signals are taken as measured with the value ``fill``
    (default 0).  ``df``: id and one column per signal; ties keep the order of id."""
    fill = fill or {}
    neutral = {s: F.coalesce(F.col(s), F.lit(float(fill.get(s, 0.0)))) for s in weights}
    cases: list[tuple[str, Column]] = [("", fu.fair_score({s: F.col(s) for s in weights}, weights)[0])]
    cases.append(("missingness", fu.fair_score(neutral, weights)[0]))
    for name, gone in drops.items():
        w = {s: 0.0 if s in set(gone) else x for s, x in weights.items()}
        cases.append((f"group:{name}", fu.fair_score({s: F.col(s) for s in weights}, w)[0]))
    rows = df.select("id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), (-F.round(c, digits)).alias("o")) for n, c in cases
    ])).alias("x")).select("id", "x.name", "x.o")
    placed = cut(row_numbers(rows, ["name"], ["o", "id"], "place").select("name", "id", "place"))
    base = placed.where("name = ''").select("id", F.col("place").alias("pa"))
    both = cut(placed.where("name <> ''").withColumnRenamed("place", "pb").join(base, "id"))
    rho = both.groupBy("name").agg(F.corr("pa", "pb").alias("spearman"))
    top = topk_overlap(both, [k], ["name"]).select("name", "jaccard", F.col("n_entered").alias("n_moved_in"))
    return rho.join(top, "name")


def weight_sensitivity(df: DataFrame, weights: Mapping[str, float], n_iter: int, spread: float = 0.5, seed: int = 42,
                       digits: int = 9) -> DataFrame:
    """(id, baseline_rank, mean_rank, std_rank, min_rank, max_rank, rank_stability)
    under random weights of base ± spread.  The weights of a scenario come from a hash
    of (seed, scenario, signal); they are constants of the plan."""
    def weight(it: int, s: str) -> float:
        u = int(hashlib.md5(f"{seed}|{it}|{s}".encode()).hexdigest()[:8], 16) / 4294967296.0
        return float(weights[s]) * (1 + spread * (2 * u - 1)) if it else float(weights[s])

    cases = [F.struct(F.lit(it).alias("it"), *[F.lit(weight(it, s)).alias(f"w_{s}") for s in weights]) for it in range(n_iter + 1)]
    many = df.select("id", *weights, F.explode(F.array(*cases)).alias("c")).select("id", *weights, "c.*")
    total = present = summed = F.lit(0.0)
    for s in weights:
        eff, ok = F.col(f"w_{s}"), F.col(s).isNotNull()
        total = total + eff
        present = present + F.when(ok, eff).otherwise(0.0)
        summed = summed + F.when(ok, eff * F.col(s)).otherwise(0.0)
    score = F.when(present > 0, summed / present * F.greatest(F.lit(0.4), present / total)).otherwise(0.0)
    rows = ranked(many.select("id", "it", F.round(score, digits).alias("score")), ["it"], "score", "rank", descending=True)
    n = df.agg(F.count("*").alias("v")).scalar()
    trial = F.col("it") > 0
    s = rows.groupBy("id").agg(
        F.max(F.when(~trial, F.col("rank"))).alias("baseline_rank"), F.avg(F.when(trial, F.col("rank"))).alias("mean_rank"),
        F.stddev_pop(F.when(trial, F.col("rank"))).alias("std_rank"), F.min(F.when(trial, F.col("rank"))).alias("min_rank"),
        F.max(F.when(trial, F.col("rank"))).alias("max_rank"),
    )
    return s.select("*", n.alias("__n")).withColumn("rank_stability", 1 - F.col("std_rank") / F.col("__n")).drop("__n")


def signal_variance(ranks: DataFrame) -> DataFrame:
    """(id, disagreement): population variance of an id's normalized ranks."""
    return ranks.groupBy("id").agg(
        F.when(F.count("*") < 2, 0.0).otherwise(F.var_pop("r")).alias("disagreement")
    )


def select_batch(order: DataFrame, ranks: DataFrame, labels: DataFrame, batch: int, mode: str = "active", multiplier: int = 3,
                 barred: Sequence[str] = (), digits: int = 12) -> DataFrame:
    """(id, seat, cluster): up to ``batch`` ids, disputed ones first inside the best
    ``batch * multiplier``, no cluster above ceil(batch / clusters).

    ``order``: id, place; ``labels``: id, classification, cluster (blank = its own).
    """
    if mode not in ("active", "topscore"):
        raise ValueError(f"unknown mode {mode!r}: use 'active' or 'topscore'")
    rows = order.join(labels, "id", "left")
    rows = rows.where(F.col("classification").isNull() | ~F.col("classification").isin(list(barred) or [""]))
    own = F.concat(F.lit("__alone__"), F.col("id").cast("string"))
    rows = rows.withColumn("cluster", F.when(F.coalesce("cluster", F.lit("")) == "", own).otherwise(F.col("cluster")))
    rows = row_numbers(rows.select("id", "place", "cluster"), [], ["place"], "seat0")
    if mode == "active":
        rows = rows.join(signal_variance(ranks), "id", "left")
        tier = F.col("seat0") <= batch * multiplier
        rows = rows.select("id", "cluster", F.when(tier, 0).otherwise(1).alias("t"),
                           F.when(tier, -F.round(F.coalesce("disagreement", F.lit(0.0)), digits)).otherwise(0.0).alias("d"), "seat0")
    else:
        rows = rows.select("id", "cluster", F.lit(0).alias("t"), F.lit(0.0).alias("d"), "seat0")
    rows = cut(rows)
    clusters = max(1, rows.select("cluster").distinct().count())
    cap = math.ceil(batch / clusters)
    inside = Window.partitionBy("cluster").orderBy("t", "d", "seat0")
    kept = rows.withColumn("in_cluster", F.row_number().over(inside)).where(F.col("in_cluster") <= cap)
    # at most `batch` rows are left after the limit, so the final numbering is one small task
    best = kept.orderBy("t", "d", "seat0").limit(batch)
    return best.select("id", F.row_number().over(Window.orderBy("t", "d", "seat0")).alias("seat"), "cluster")


def confidence_view(df: DataFrame, label: str, min_completeness: float = 0.7) -> DataFrame:
    """Candidates of the wanted class, not under review, with enough evidence."""
    rows = df
    if "classification" in df.columns:
        rows = rows.where(F.col("classification") == label)
    if "needs_manual_review" in df.columns:
        rows = rows.where(F.coalesce("needs_manual_review", F.lit("")) != "yes")
    if "evidence_completeness" in df.columns:
        rows = rows.where(F.col("evidence_completeness") >= min_completeness)
    return rows.orderBy("final_rank") if "final_rank" in df.columns else rows


def discovery_members(df: DataFrame, label: str, tandem_high: float = 0.5) -> DataFrame:
    """Candidates of the wanted class with a poor group, an open review or a large
    tandem score."""
    keep = F.lit(False)
    if "og_dnds_reliability" in df.columns:
        keep = keep | (F.coalesce("og_dnds_reliability", F.lit("")) == "low")
    if "needs_manual_review" in df.columns:
        keep = keep | (F.coalesce("needs_manual_review", F.lit("")) == "yes")
    if "tandem" in df.columns:
        keep = keep | (F.coalesce("tandem", F.lit(0.0)) >= tandem_high)
    return df.where(keep & (F.col("classification") == label)) if "classification" in df.columns else df.where(keep)


def discovery_view(df: DataFrame, signals: Sequence[str], label: str, tandem_high: float = 0.5) -> DataFrame:
    """Members of the discovery view with ``rho`` and ``discovery_score`` = -log10 of
    the fused p-value over their own ranks."""
    rows = cut(discovery_members(df, label, tandem_high))
    votes = fu.build_ranklists(rows, [fu.Signal(s, s) for s in signals])
    scores = fu.rra_score(votes).select("id", "rho", (-F.log10(F.greatest("score", F.lit(1e-300)))).alias("discovery_score"))
    return rows.join(scores, "id", "left").withColumn("discovery_score", F.coalesce("discovery_score", F.lit(0.0)))


def tiers_by_gap(df: DataFrame, score: str = "rank_score") -> DataFrame:
    """``df`` plus ``tier``: 1 from the 90th percentile up, 2 from the largest drop
    inside the best 60 % up, else 3."""
    rows = cut(row_numbers(df.withColumn("__o", -F.col(score)), [], ["__o", "id"], "__place"))
    p90 = percentiles(rows, [], score, {"p": 0.9}).select("p").scalar()
    n = rows.agg(F.count("*").alias("v")).scalar()
    nxt = rows.select((F.col("__place") - 1).alias("__place"), F.col(score).alias("__next"))
    gaps = rows.withColumn("__n", n).where(F.col("__place") <= F.greatest(F.lit(10), F.floor((F.col("__n") - 1) * 0.6))).join(nxt, "__place")
    drop = gaps.agg(F.max_by("__next", F.struct(F.col(score) - F.col("__next"), -F.col("__place"))).alias("v")).scalar()
    got = rows.withColumn("__p", p90).withColumn("__d", drop)
    tier = F.when(F.col(score) >= F.col("__p"), 1).when(F.col(score) >= F.col("__d"), 2).otherwise(3)
    return got.withColumn("tier", tier).drop("__o", "__place", "__p", "__d")


def reference_crossval(df: DataFrame, refs: DataFrame, via: str, folds: int, seed: int = 42, digits: int = 9) -> DataFrame:
    """(fold, id, rank, percentile, in_top_10pct) of each held-out reference.

    ``df``: id, ``via``, other; ``refs``: id, ``via``, weight.  A row's reference score is
    the weight of the references met through ``via``; the score without fold f is the
    total minus the fold's share, so folds cost one aggregate, not one pass each.
    """
    fold = F.floor(uniform(seed, F.col("id")) * folds).cast("int")
    r = cut(refs.withColumn("fold", fold))
    total = r.groupBy(via).agg(F.sum("weight").alias("all"))
    share = r.groupBy(via, "fold").agg(F.sum("weight").alias("held"))
    many = scenarios(df, folds, "fold").join(total, via, "left").join(share, [via, "fold"], "left")
    score = F.coalesce("all", F.lit(0.0)) - F.coalesce("held", F.lit(0.0)) + F.col("other")
    rows = ranked(many.select("id", "fold", F.round(score, digits).alias("s")), ["fold"], "s", "rank", descending=True)
    got = rows.join(r.select("id", "fold"), ["id", "fold"], "left_semi")
    pct = 100 * (1 - F.col("rank") / F.col("rank_n"))
    return got.select("fold", "id", "rank", pct.alias("percentile"), (pct >= 90).alias("in_top_10pct"))
