"""Tests, calibration and resampling, written as joins and ordered scans.

Random draws hash (seed, scenario, item), so a recomputed task draws the same again.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.functions.seats import seat_column, seats
from evidara.operators import fusion as fu
from evidara.ordering import Scan, percentiles, positions, ranked, row_numbers, running
from evidara.graph import components
from evidara.session import cut

#: seats a task holds at a time
SEATS_AT_ONCE = 1 << 20
#: lists that are columns of one row at a time
MOST_LISTS = 64
#: first rows of a group that every task may hold back
FIRST_ROWS = 1000
#: drawn rows that a task makes, about
TASK_DRAWS = 1 << 20


def draw(*parts: Column | str | int) -> Column:
    """A hex string that orders items at random but always the same way."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) from the first 32 bits of :func:`draw`."""
    return F.conv(F.substring(draw(*parts), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def scenarios(df: DataFrame, n: int, name: str = "scenario") -> DataFrame:
    """Every row once per scenario 0..n-1 (a fixed number, set by the caller)."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name))


def tasks_for(rows: int, df: DataFrame) -> int:
    """Number of tasks that keeps about ``TASK_DRAWS`` of so many rows in each, at least one for every core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_DRAWS))


def counts_below(points: DataFrame, reference: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, below, equal, n) for the distinct values of ``points``: how many
    ``reference`` values of the same keys are smaller, equal, and there at all."""
    keys = list(keys)
    both = (
        reference.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("w"))
        .select(*keys, value, "w", F.lit(False).alias("asked"))
        .unionByName(points.where(F.col(value).isNotNull()).select(*keys, value).distinct()
                     .select(*keys, value, F.lit(0).cast("long").alias("w"), F.lit(True).alias("asked")))
    )
    rows = cut(both.groupBy(*keys, value).agg(F.sum("w").alias("equal"), F.max("asked").alias("asked")))
    got = running(rows, keys, [value], {"below": Scan("sum", F.col("equal"))}, cut_input=False)
    got = got.where("asked").select(*keys, value, F.coalesce("below", F.lit(0)).cast("long").alias("below"), "equal")
    n = rows.groupBy(*keys).agg(F.sum("equal").alias("n"))
    return got.join(n, keys) if keys else got.withColumn("n", n.scalar())


def benjamini_hochberg(df: DataFrame, p: str, out: str = "q", keys: Sequence[str] = ()) -> DataFrame:
    """``df`` plus the corrected p-value; null and NaN stay null and do not count."""
    keys = list(keys)
    src = cut(df.withColumn("__p", F.when(~F.isnan(F.col(p)), F.col(p))))
    pos = positions(src, keys, "__p")
    pos = pos.withColumn("__raw", F.col("__p") * F.col("n") / (F.col("below") + F.col("ties")))
    got = running(pos, keys, ["__p"], {"__q": Scan("min", F.col("__raw"), "from")})
    got = got.select(*keys, "__p", F.least(F.col("__q"), F.lit(1.0)).alias(out))
    return src.join(got, keys + ["__p"], "left").drop("__p")


def absrel_fdr_merge(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    """(branch_id, corrected_p, significant): rows that carry a corrected p-value keep
    it and win over others of the branch; the rest are corrected as one pool and the
    last written one (largest ``pos``) stays.  Missing p counts as 1, missing omega drops."""
    rows = df.where(F.col("omega").isNotNull() & ~F.isnan("omega"))
    done = (F.coalesce(F.col("is_already_corrected"), F.lit(0)) == 1) & F.col("corrected_p_value").isNotNull()
    pool = rows.where(~done).withColumn("p_value", F.coalesce("p_value", F.lit(1.0)))
    pool = benjamini_hochberg(pool.select("branch_id", "pos", "p_value"), "p_value", "corrected_p")
    kept = rows.where(done).select("branch_id", "pos", F.col("corrected_p_value").alias("corrected_p"))
    both = pool.select("branch_id", "pos", "corrected_p", F.lit(0).alias("rank")).unionByName(
        kept.withColumn("rank", F.lit(1))
    )
    got = both.groupBy("branch_id").agg(F.max_by("corrected_p", F.struct("rank", "pos")).alias("corrected_p"))
    return got.withColumn("significant", F.col("corrected_p") < threshold)


def chi2_sf(x: np.ndarray, df: int) -> np.ndarray:
    """Upper tail for whole degrees of freedom by the finite recurrence."""
    half = np.maximum(np.asarray(x, dtype=float), 0.0) / 2.0
    if df % 2:
        tail, a = np.array([math.erfc(math.sqrt(v)) for v in half]), 0.5
    else:
        tail, a = np.exp(-half), 1.0
    while a < df / 2:
        with np.errstate(divide="ignore"):
            tail = tail + np.exp(np.where(half > 0, a * np.log(half), -np.inf) - half - math.lgamma(a + 1))
        a += 1.0
    return tail


def lrt_pvalue(statistic: Column, df: int, boundary: bool = False) -> Column:
    """Likelihood-ratio p-value: 1 where the statistic is not positive; half of the
    tail for a parameter on the boundary.  Even degrees have a finite sum; odd ones need the
    error function, which Spark lacks."""
    if df % 2 == 0:
        half = statistic / 2.0
        p = sum((F.pow(half, i) / math.factorial(i) for i in range(1, df // 2)), F.lit(1.0)) * F.exp(-half)
        return F.when(statistic <= 0, 1.0).otherwise(p * 0.5 if boundary else p)

    @F.pandas_udf(T.DoubleType())
    def tail(x: pd.Series) -> pd.Series:
        return pd.Series(chi2_sf(x.to_numpy(dtype=float), df), index=x.index)

    p = tail(statistic)
    return F.when(statistic <= 0, 1.0).otherwise(p * 0.5 if boundary else p)


def mann_whitney(df: DataFrame, value: str, is_a: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n_a, n_b, u, z, rank_biserial) from average ranks with tie correction and
    continuity correction."""
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, value, is_a.alias("a"))
    c = cut(rows.groupBy(*keys, value).agg(F.count("*").alias("ties"), F.count_if("a").alias("na")))
    pos = running(c, keys, [value], {"below": Scan("sum", F.col("ties"))}, cut_input=False)
    t = F.col("ties").cast("double")
    rank = F.coalesce("below", F.lit(0)) + (t + 1) / 2
    s = pos.groupBy(*keys).agg(
        F.sum(F.col("na") * rank).alias("ra"), F.sum("na").alias("n_a"),
        F.sum(F.col("ties") - F.col("na")).alias("n_b"), F.sum(t * t * t - t).alias("tie"),
    )
    u = F.col("ra") - F.col("n_a") * (F.col("n_a") + 1) / 2
    n = (F.col("n_a") + F.col("n_b")).cast("double")
    mean = F.col("n_a") * F.col("n_b") / 2
    sd = F.sqrt(F.col("n_a") * F.col("n_b") / 12 * ((n + 1) - F.coalesce(F.try_divide("tie", n * (n - 1)), F.lit(0.0))))
    big = F.greatest(u, F.col("n_a") * F.col("n_b") - u)
    return s.select(
        *keys, "n_a", "n_b", u.alias("u"), F.try_divide(big - mean - 0.5, sd).alias("z"),
        (F.try_divide(2 * u, (F.col("n_a") * F.col("n_b")).cast("double")) - 1).alias("rank_biserial"),
    )


def spearman(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, rho) over the rows where both values are present."""
    keys = list(keys)
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*keys, a, b)
    rows = ranked(rows, keys, a, "ra").drop("ra_n")
    rows = ranked(rows, keys, b, "rb").drop("rb_n")
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.corr("ra", "rb").alias("rho"))


def kendall_tau(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row (n, tau), tie-corrected.

    Discordant pairs are counted without forming pairs: ``a`` is replaced by its dense
    place; two rows differ first at exactly one bit of it, so for every bit the rows
    that share the higher bits meet as two sides and a running count over ``b`` tells
    how many of one side lie below the other.  n log n rows.
    """
    src = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    joint = cut(src.groupBy("a", "b").agg(F.count("*").cast("double").alias("c")))
    ac = cut(joint.groupBy("a").agg(F.sum("c").alias("c")))
    ai = row_numbers(ac, [], ["a"], "i")
    bits = max(1, int(math.ceil(math.log2(max(2, ac.count() + 1)))))
    cells = joint.join(ai.select("a", "i"), "a").select(
        "b", "c", "i", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("bit")
    )
    one = F.expr("(shiftright(i, bit) & 1) = 1")
    side = cells.groupBy("bit", F.expr("shiftright(i, bit + 1)").alias("block"), "b").agg(
        F.sum(F.when(one, F.col("c")).otherwise(0.0)).alias("hi"),
        F.sum(F.when(~one, F.col("c")).otherwise(0.0)).alias("lo"),
    )
    got = running(side, ["bit", "block"], ["b"], {"hi_below": Scan("sum", F.col("hi"))})
    pairs = F.sum(F.col("c") * (F.col("c") - 1) / 2)
    disc = got.agg(F.sum(F.col("lo") * F.coalesce("hi_below", F.lit(0.0))).alias("d")).scalar()
    tie_a = ac.agg(pairs.alias("v")).scalar()
    tie_b = joint.groupBy("b").agg(F.sum("c").alias("c")).agg(pairs.alias("v")).scalar()
    one_row = joint.agg(F.sum("c").alias("n"), pairs.alias("tie_ab")).select(
        "n", "tie_ab", disc.alias("d"), tie_a.alias("ta"), tie_b.alias("tb")
    )
    total = F.col("n") * (F.col("n") - 1) / 2
    con_minus_dis = total - F.col("ta") - F.col("tb") + F.col("tie_ab") - 2 * F.coalesce("d", F.lit(0.0))
    return one_row.select(
        F.col("n").cast("long").alias("n"),
        F.try_divide(con_minus_dis, F.sqrt((total - F.col("ta")) * (total - F.col("tb")))).alias("tau"),
    )


def wilcoxon_signed_rank(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row (n, statistic, z): smaller of the two signed rank sums over the non-zero
    differences, with the tie-corrected normal approximation."""
    d = df.select((F.col(a) - F.col(b)).alias("d")).where("d <> 0").withColumn("m", F.abs("d"))
    r = ranked(d, [], "m", "rank")
    s = r.agg(
        F.sum(F.when(F.col("d") > 0, F.col("rank")).otherwise(0.0)).alias("plus"),
        F.sum(F.when(F.col("d") < 0, F.col("rank")).otherwise(0.0)).alias("minus"),
        F.count("*").alias("n"),
    )
    t = F.col("t").cast("double")
    ties = d.groupBy("m").agg(F.count("*").alias("t")).agg(F.sum(t * t * t - t).alias("v")).scalar()
    s = s.select("*", ties.alias("tie"), F.least("plus", "minus").alias("statistic"))
    n = F.col("n").cast("double")
    sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("tie") / 48)
    return s.select("n", "statistic", ((F.col("statistic") - n * (n + 1) / 4) / sd).alias("z"))


def percentile_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and percentiles of the values, and mean / p95 of the group maxima."""
    src = cut(df.select(group, value))
    p = percentiles(src, [], value, {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99})
    tops = cut(src.groupBy(group).agg(F.max(value).alias("top")))
    mean = src.agg(F.avg(value).alias("v")).scalar()
    top_mean = tops.agg(F.avg("top").alias("v")).scalar()
    top95 = percentiles(tops, [], "top", {"v": 0.95}).select("v").scalar()
    return p.select(
        "n", mean.alias("mean"), "median", "p75", "p90", "p95", "p99",
        top_mean.alias("group_max_mean"), top95.alias("group_max_p95"),
    )


def empirical_pvalue(observed: DataFrame, null: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Right-tail (b + 1) / (m + 1), excess over the null in population standard
    deviations, and whether the null reaches the observed value.
    ``observed``: keys, value; ``null``: keys, null_value."""
    rows = null.join(observed, list(keys))
    s = rows.groupBy(*keys).agg(
        F.max("value").alias("value"), F.count_if(F.col("null_value") >= F.col("value")).alias("b"),
        F.count("*").alias("m"), F.avg("null_value").alias("null_mean"), F.stddev_pop("null_value").alias("null_std"),
    )
    low = F.col("value") <= F.col("null_mean")
    flat = F.when(low, F.lit(0.0)).otherwise(F.lit(float("inf")))
    return s.select(
        *keys, ((F.col("b") + 1) / (F.col("m") + 1)).alias("p_value"), "null_mean", "null_std",
        F.when(F.col("null_std") == 0, flat).otherwise((F.col("value") - F.col("null_mean")) / F.col("null_std")).alias("excess"),
        low.alias("collapsed"),
    )


def conformal_pvalues(points: DataFrame, calibration: DataFrame, id_col: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """(id, p): (1 + number of calibration scores >= the point's) / (n + 1)."""
    keys = list(keys)
    got = counts_below(points, calibration, keys, score)
    got = got.withColumn("p", (1 + F.col("n") - F.col("below")) / (F.col("n") + 1))
    return points.join(got.select(*keys, score, "p"), keys + [score]).select(id_col, *keys, "p")


def confound_residuals(df: DataFrame, novelty: str, confounds: Sequence[str], id_col: str = "id") -> DataFrame:
    """(id, residual): average rank of ``novelty`` minus its least-squares fit on the
    average ranks of the confounds, over rows that have them all.  The driver solves
    the (number of confounds + 1)-square system from one row of sums."""
    rows = df
    for c in [novelty, *confounds]:
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(F.col(c)))
    rows = rows.select(id_col, novelty, *confounds)
    for c in [novelty, *confounds]:
        rows = ranked(rows, [], c, f"__r_{c}").drop(f"__r_{c}_n")
    rows = cut(rows)
    xs = [F.lit(1.0), *[F.col(f"__r_{c}") for c in confounds]]
    k = len(xs)
    y = F.col(f"__r_{novelty}")
    sums = rows.agg(
        *[F.sum(xs[i] * xs[j]).alias(f"x{i}_{j}") for i in range(k) for j in range(i, k)],
        *[F.sum(xs[i] * y).alias(f"y{i}") for i in range(k)],
    ).first()
    if sums["x0_0"] is None:
        return rows.select(id_col, F.lit(0.0).alias("residual"))
    m = np.array([[sums[f"x{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], dtype=float)
    beta = np.linalg.lstsq(m, np.array([sums[f"y{i}"] for i in range(k)], dtype=float), rcond=None)[0]
    fit = sum((F.lit(float(b)) * x for b, x in zip(beta[1:], xs[1:])), F.lit(float(beta[0])))
    return rows.select(id_col, (y - fit).alias("residual"))


def pair_correlations(long: DataFrame, min_n: int = 3) -> DataFrame:
    """(a, b, n, rho) for every pair of signals of (id, signal, value), each over the
    ids that have both; 0 where fewer than ``min_n`` or no spread."""
    left = long.select("id", F.col("signal").alias("a"), F.col("value").alias("va"))
    right = long.select("id", F.col("signal").alias("b"), F.col("value").alias("vb"))
    pairs = left.join(right, "id").where("a < b")
    got = spearman(pairs, "va", "vb", ["a", "b"])
    rho = F.when((F.col("n") >= min_n) & F.col("rho").isNotNull() & ~F.isnan("rho"), F.col("rho")).otherwise(0.0)
    return got.select("a", "b", "n", rho.alias("rho"))


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (a, b)."""
    found = components(edges).withColumnRenamed("node", "__n").withColumnRenamed("component", "__c")
    return nodes.join(found, F.col("node") == F.col("__n"), "left").select("node", F.coalesce("__c", "node").alias("component"))


def topk_separation(scores: DataFrame, k: int, key: str = "scenario") -> DataFrame:
    """(key, separation): gap of mean -log10 score between the best k and the rest."""
    sig = -F.log10(F.greatest(F.col("score"), F.lit(1e-300)))
    rows = cut(scores.select(key, "id", "score", sig.alias("sig")))
    if k <= FIRST_ROWS:
        # every task keeps its own k best of each key before they meet
        order = Window.partitionBy(key).orderBy("score", "id")
        best = rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    else:
        best = row_numbers(rows, [key], ["score", "id"], "rn").where(F.col("rn") <= k)
    best = best.groupBy(key).agg(F.sum("sig").alias("ts"), F.count("*").alias("tn"))
    al = rows.groupBy(key).agg(F.sum("sig").alias("s"), F.count("*").alias("n"))
    gap = F.abs((F.col("s") - F.col("ts")) / (F.col("n") - F.col("tn")) - F.col("ts") / F.col("tn"))
    return al.join(best, key).select(key, F.when(F.col("n") <= k, 0.0).otherwise(gap).alias("separation"))


def permuted_votes(ranks: DataFrame, n_perm: int, seed: int = 0) -> DataFrame:
    """(scenario, id, list, r): in every scenario each signal's normalized ranks are
    dealt anew to the ids that vote on it.  Ranks do not change when their holders
    swap, so they are moved instead of recomputed.

    The votes of a signal are sorted once.  A scenario moves every place by a bijection
    that the row's own task evaluates (:mod:`evidara.functions.seats`), so nothing is sorted by scenario;
    signals (in alphabetical order) and scenarios number the bijections."""
    place = cut(row_numbers(ranks.select("signal", "id", "r"), ["signal"], ["r", "id"], "place"))
    sizes = place.groupBy("signal").agg(F.count("*").alias("n"))
    numbers = row_numbers(sizes, [], ["signal"], "number")
    # few narrow rows become many: they are dealt to tasks by what they become
    parts = tasks_for(place.count() * n_perm, place)
    many = scenarios(place.join(F.broadcast(numbers), "signal").repartition(parts, "signal", "place"), n_perm)
    signals = sizes.agg(F.count("*")).scalar()
    moved = seat_column(F.col("place") - 1, F.col("scenario") * signals + F.col("number") - 1, F.col("n"), seed)
    dealt = many.select("scenario", "id", "signal", (moved + 1).alias("place"))
    seat = ["signal", "place"]
    return dealt.repartition(parts, *seat).join(place.select(*seat, "r").repartition(parts, *seat).hint("shuffle_hash"), seat).select(
        "scenario", "id", F.col("signal").alias("list"), "r"
    )


def permutation_null(votes: DataFrame, k: int, n_perm: int, seed: int = 0) -> DataFrame:
    """One row (observed, n_ge, n_perm, p_value) for the separation of the top k."""
    ranks = cut(fu.normalized_ranks(votes))
    lists = ranks.select(F.lit(-1).alias("scenario"), "id", F.col("signal").alias("list"), "r").unionByName(
        permuted_votes(ranks, n_perm, seed)
    )
    once = ranks.groupBy("id", "signal").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    names = [r["signal"] for r in ranks.select("signal").distinct().limit(MOST_LISTS + 1).collect()]
    rho = cut(fu.rho_from_lists(lists, ["scenario", "id"], sorted(names) if once and len(names) <= MOST_LISTS else None))
    sep = cut(topk_separation(fu.rra_from_rho(rho), k))
    seen = sep.where("scenario = -1").select("separation").scalar()
    rows = sep.select("scenario", "separation", seen.alias("observed"))
    return rows.agg(
        F.max("observed").alias("observed"),
        F.count_if((F.col("scenario") >= 0) & (F.col("separation") >= F.col("observed"))).alias("n_ge"),
        F.count_if(F.col("scenario") >= 0).alias("n_perm"),
    ).withColumn("p_value", (F.col("n_ge") + 1) / (F.col("n_perm") + 1))


def resampled_slots(spark, n_boot: int, n_signals: int, seed: int = 0) -> DataFrame:
    """(scenario, slot, pick): per scenario as many of the signals 0..n-1 as there are, drawn with replacement."""
    slots = scenarios(spark.range(1).select(F.lit(0).alias("x")), n_boot).select(
        "scenario", F.explode(F.sequence(F.lit(0), F.lit(n_signals - 1))).alias("slot")
    )
    return slots.withColumn("pick", F.floor(uniform(seed, F.col("scenario"), F.col("slot")) * n_signals).cast("int"))


def resampled_ranks(ranks: DataFrame, signals: Sequence[str], n_boot: int, seed: int = 0) -> DataFrame:
    """(id, scenario, rs): the entries (list, r) of an id in every scenario, empty where none of its signals is drawn.

    An id's ranks are collected once and every scenario picks from them, so nothing is shuffled for each scenario.
    The draws, scenarios x signals, are part of the plan."""
    drawn = resampled_slots(ranks.sparkSession, n_boot, len(signals), seed).orderBy("scenario", "slot").collect()
    mine = ranks.groupBy("id").agg(*[F.collect_list(F.when(F.col("signal") == s, F.col("r"))).alias(f"__{i}") for i, s in enumerate(signals)])

    def entries(scenario: int) -> Column:
        return F.struct(F.lit(scenario).alias("scenario"), F.array(*[
            F.struct(F.lit(d["slot"]).alias("list"), F.col(f"__{d['pick']}").alias("r")) for d in drawn if d["scenario"] == scenario]).alias("rs"))

    got = mine.select("id", F.explode(F.array(*[entries(i) for i in range(n_boot)])).alias("x"))
    return got.select("id", "x.scenario", "x.rs")


def resampled_lists(ranks: DataFrame, signals: Sequence[str], n_boot: int, seed: int = 0) -> DataFrame:
    """(scenario, id, list, r): per scenario as many signals as there are, drawn with
    replacement; a signal drawn twice votes twice."""
    got = resampled_ranks(ranks, signals, n_boot, seed).select("scenario", "id", F.explode("rs").alias("x"))
    return got.select("scenario", "id", "x.list", F.explode("x.r").alias("r"))


def bootstrap_rank_ci(votes: DataFrame, signals: Sequence[str], k: int, n_boot: int, seed: int = 0,
                      alpha: float = 0.05, high: float = 0.8, plausible: float = 0.2) -> DataFrame:
    """(id, rank_ci_lo, rank_ci_hi, rank_median, p_top_k, rank_tier) over resampled
    signal sets; an id without any drawn signal takes the last place."""
    ranks = cut(fu.normalized_ranks(votes))
    drawn = resampled_ranks(ranks, signals, n_boot, seed).select("scenario", "id", F.flatten("rs.r").alias("rs")).where(F.size("rs") > 0)
    rho = cut(fu.rho_from_arrays(drawn, ["scenario", "id"]))
    places = row_numbers(fu.rra_from_rho(rho), ["scenario"], ["score", "id"], "place").select("scenario", "id", "place")
    ids = ranks.select("id").distinct()
    last = ids.agg(F.count("*").alias("v")).scalar()
    # one value per scenario and id, so the array is as long as n_boot
    seen = places.groupBy("id").agg(F.collect_list("place").alias("seen"), F.count_if(F.col("place") <= k).alias("top"))
    every = ids.join(seen, "id", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<bigint>")))
    missing = F.lit(n_boot) - F.size("seen")
    every = every.select("id", F.sort_array(F.concat("seen", F.array_repeat(last, missing))).alias("places"),
                         (F.coalesce("top", F.lit(0)) + F.when(last <= k, missing).otherwise(0)).alias("top"))

    def percentile(p: float) -> Column:
        at = (n_boot - 1) * p
        lo, hi = math.floor(at), math.ceil(at)
        below, above = F.get("places", F.lit(lo)), F.get("places", F.lit(hi))
        # equal neighbours are the value itself, which the weighted sum may miss by its last bit
        return F.when(below == above, below.cast("double")).otherwise((hi - at) * below + (at - lo) * above)

    got = every.select(
        "id", F.array(*[percentile(p) for p in (alpha / 2, 1 - alpha / 2, 0.5)]).alias("q"),
        (F.col("top") / F.lit(n_boot)).alias("p_top_k"),
    )
    return got.select(
        "id", F.floor(F.get("q", F.lit(0))).alias("rank_ci_lo"), F.floor(F.get("q", F.lit(1))).alias("rank_ci_hi"),
        F.get("q", F.lit(2)).alias("rank_median"), "p_top_k",
        F.when(F.col("p_top_k") >= high, "high").when(F.col("p_top_k") >= plausible, "plausible")
        .otherwise("tail").alias("rank_tier"),
    )


def enrichment_null(order: DataFrame, positives: DataFrame, k: int, n_perm: int, seed: int = 0) -> DataFrame:
    """One row: mean place of the positives and share among the first k, each against
    random sets of the same size.  ``order``: id, place (1 to the number of ids, each once);
    ``positives``: id, those that are not in ``order`` do not count.

    A random set is the seats that a bijection of all places gives to the first ``size`` places;
    tasks add them up block by block, so neither sets nor orders are written or sorted."""
    o = cut(order.join(positives.select("id", F.lit(True).alias("hit")), "id", "left"))
    total, last, size = o.agg(F.count("*"), F.max("place"), F.count("hit")).first()
    if total != (last or 0):
        raise ValueError(f"places must be 1 to {total}, the last is {last}")
    seen = o.where("hit").agg(
        F.avg("place").alias("mean"), (F.count_if(F.col("place") <= k) / F.lit(k)).alias("prec")
    )
    step = max(1, SEATS_AT_ONCE // n_perm)

    def drawn(batches):
        for batch in batches:
            if not len(batch):
                continue
            sums, hits = np.zeros(n_perm, np.int64), np.zeros(n_perm, np.int64)
            for a in range(0, len(batch), step):
                places = 1 + seats(batch["id"].to_numpy()[a : a + step, None], np.arange(n_perm), total, seed)
                sums += places.sum(axis=0)
                hits += (places <= k).sum(axis=0)
            yield pd.DataFrame({"scenario": np.arange(n_perm), "places": sums, "hits": hits})

    sums = o.sparkSession.range(size).mapInPandas(drawn, "scenario long, places long, hits long")
    null = sums.groupBy("scenario").agg(
        (F.sum("places") / F.lit(size)).alias("mean"), (F.sum("hits") / F.lit(k)).alias("prec")
    )
    null = null.select("mean", "prec", seen.select("mean").scalar().alias("om"), seen.select("prec").scalar().alias("op"))
    return null.agg(
        F.lit(size).cast("long").alias("n_positives"), F.max("om").alias("observed_mean_rank"),
        ((F.count_if(F.col("mean") <= F.col("om")) + 1) / (F.count("*") + 1)).alias("p_value"),
        F.max("op").alias("precision_at_k"),
        ((F.count_if(F.col("prec") >= F.col("op")) + 1) / (F.count("*") + 1)).alias("precision_p_value"),
    )


def bootstrap_ci_diff(df: DataFrame, a: str, b: str, n_boot: int, seed: int = 0, alpha: float = 0.05,
                      id_col: str = "id") -> DataFrame:
    """One row (observed, ci_lo, ci_hi): mean of a - b over paired resamples.

    Every draw picks a seat 0..n-1; the draws are counted per seat before they meet
    the rows, so a resample costs one aggregate."""
    rows = cut(row_numbers(df.select(id_col, (F.col(a) - F.col(b)).alias("d")), [], [id_col], "seat"))
    n = rows.count()
    parts = tasks_for(n * n_boot, rows)
    drawn = rows.sparkSession.range(0, n * n_boot, 1, parts).select(F.floor(F.col("id") / n).cast("int").alias("scenario"), (F.col("id") % n + 1).alias("seat"))
    pick = F.floor(uniform(seed, F.col("scenario"), F.col("seat")) * n) + 1
    # a task counts the draws of few seats, in all scenarios
    draws = drawn.select("scenario", pick.alias("seat")).repartition(parts, "seat").groupBy("seat", "scenario").count()
    means = draws.join(rows.select("seat", "d").repartition(parts, "seat"), "seat").groupBy("scenario").agg(
        (F.sum(F.col("d") * F.col("count")) / F.sum("count")).alias("m")
    )
    q = means.agg(F.percentile("m", F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))).alias("q"))
    seen = rows.agg(F.avg("d").alias("v")).scalar()
    return q.select(seen.alias("observed"), F.get("q", F.lit(0)).alias("ci_lo"), F.get("q", F.lit(1)).alias("ci_hi"))


def evalue_threshold(rows: DataFrame, target_recall: float = 0.9, target_precision: float = 0.95,
                     default: float = 1e-20) -> DataFrame:
    """(family, threshold): per family the loosest e-value that keeps recall and
    precision; the walk starts where recall is met and stops at the first failure.
    ``rows``: truth, predicted, evalue."""
    totals = rows.groupBy(F.col("truth").alias("family")).agg(F.count("*").alias("n"))
    hits = cut(
        rows.groupBy(F.col("predicted").alias("family"), "evalue").agg(
            F.count_if(F.col("truth") == F.col("predicted")).alias("tp"),
            F.count_if(F.col("truth") != F.col("predicted")).alias("fp"),
        )
    )
    walk = running(hits, ["family"], ["evalue"], {
        "ctp": Scan("sum", F.col("tp"), "upto"), "cfp": Scan("sum", F.col("fp"), "upto"),
    }, cut_input=False).where("tp > 0").join(totals, "family")
    need = F.greatest(F.lit(1), F.floor(F.lit(target_recall) * F.col("n") + 0.999))
    walk = walk.where(F.col("ctp") >= need).withColumn(
        "ok", (F.col("ctp") / (F.col("ctp") + F.col("cfp")) >= target_precision) & (F.col("ctp") / F.col("n") >= target_recall)
    )
    walk = cut(walk.select("family", "evalue", "ok"))
    fail = walk.where(~F.col("ok")).groupBy("family").agg(F.min("evalue").alias("fail"))
    best = walk.join(fail, "family", "left").where(F.col("fail").isNull() | (F.col("evalue") < F.col("fail")))
    best = best.groupBy("family").agg(F.max("evalue").alias("t"))
    return totals.join(best, "family", "left").select("family", F.coalesce("t", F.lit(default)).alias("threshold"))


def roc_youden(tp: DataFrame, fp: DataFrame, margin: str, step: float = 0.1) -> DataFrame:
    """(m, retention, rejection, j) on the grid 0, step, 2·step … one step past the
    largest finite margin; infinite margins are always kept."""
    t = cut(tp.select(F.col(margin).alias("x")))
    f = cut(fp.select(F.col(margin).alias("x")))
    inf = F.lit(float("inf"))
    top = t.unionByName(f).where(F.col("x") < inf).agg(F.max("x").alias("v")).first()["v"]
    n = int(round(((1.0 if top is None else top) + step) / step)) + 1
    # a margin counts in all grid points up to its own, so one bucket count per sample
    # and a running sum replace the grid x sample comparison
    grid = t.sparkSession.range(n).select(F.col("id").cast("long").alias("g"), F.round(F.col("id") * step, 4).alias("m"))

    def cell(df: DataFrame, name: str) -> DataFrame:
        place = F.least(F.floor(F.col("x") / step), F.lit(n - 1)).cast("long")
        place = F.when(F.round((place + 1) * step, 4) <= F.col("x"), place + 1).otherwise(place)
        place = F.when(F.round(place * step, 4) > F.col("x"), place - 1).otherwise(place)
        place = F.when(F.col("x") >= inf, F.lit(n - 1).cast("long")).otherwise(place)
        return df.groupBy(place.alias("g")).agg(F.count("*").alias(name))

    from_here = Window.orderBy(F.desc("g")).rowsBetween(Window.unboundedPreceding, 0)
    pts = grid.join(cell(t, "ct"), "g", "left").join(cell(f, "cf"), "g", "left").select(
        "m", F.sum(F.coalesce("ct", F.lit(0))).over(from_here).alias("kept"),
        F.sum(F.coalesce("cf", F.lit(0))).over(from_here).alias("passed"),
        t.agg(F.count("*").alias("v")).scalar().alias("nt"), f.agg(F.count("*").alias("v")).scalar().alias("nf"),
    )
    nan = F.lit(float("nan"))
    ret, rej = F.coalesce(F.try_divide("kept", "nt"), nan), 1 - F.coalesce(F.try_divide("passed", "nf"), nan)
    return pts.select("m", ret.alias("retention"), rej.alias("rejection"), (ret + rej - 1).alias("j"))


def youden_recommendation(tp: DataFrame, fp: DataFrame, margin: str, step: float = 0.1, clean: float = 0.5) -> DataFrame:
    """One row: knee of the margin curve (largest j, then smallest margin), and the
    floor to use: the knee where the samples separate, else p5 / p50 of the finite
    true margins."""
    inf = F.lit(float("inf"))
    finite = cut(tp.where(F.col(margin) < inf))
    pts = roc_youden(finite, fp, margin, step)
    knee = pts.agg(F.max(F.struct("j", (-F.col("m")).alias("o"), "retention", "rejection")).alias("k"))
    p = percentiles(finite, [], margin, {"p5": 0.05, "p50": 0.5})
    one = knee.select(
        F.round(F.col("k.j"), 12).alias("knee_j"), (-F.col("k.o")).alias("knee_m"),
        p.select("p5").scalar().alias("p5"), p.select("p50").scalar().alias("p50"),
        finite.agg(F.count("*").alias("v")).scalar().alias("n_tp_multi"),
        fp.agg(F.count("*").alias("v")).scalar().alias("n_fp"),
    )
    split = F.col("knee_j") < clean
    return one.select(
        "knee_m", "knee_j", split.alias("split_advisory"), "n_tp_multi", "n_fp",
        F.when(split, F.least(F.round("p5", 2), F.round("p50", 2))).otherwise(F.round("knee_m", 2)).alias("min_margin"),
        F.when(split, F.round("p50", 2)).alias("low_margin_threshold"),
    )


def identity_separation(same: DataFrame, paralog: DataFrame, value: str, coverage: str, ceiling_pct: float = 95.0,
                        working_id: float = 95.0, working_cov: float = 80.0, min_gap: float = 0.1) -> DataFrame:
    """One row: 5th percentile of the same-gene identities against the upper percentile
    of the paralog identities and the gate that follows."""
    s = cut(same.select(value, coverage))
    floor = percentiles(s, [], value, {"p05": 0.05}).select("p05").scalar()
    cov = percentiles(s, [], coverage, {"p05": 0.05}).select("p05").scalar()
    top = percentiles(paralog, [], value, {"c": ceiling_pct / 100}).select("c").scalar()
    one = s.agg(F.count("*").alias("n_same")).select(
        "n_same", floor.alias("id_floor"), cov.alias("cov_floor"), top.alias("ceiling")
    )
    gap = F.col("id_floor") - F.col("ceiling")
    ok = F.coalesce(gap >= min_gap, F.lit(False))
    mid = (F.col("ceiling") + F.col("id_floor")) / 2
    r = F.round(mid, 1)
    inside = (F.col("ceiling") < r) & (r < F.col("id_floor"))
    return one.select(
        "n_same", "id_floor", "ceiling", gap.alias("separation_margin"), ok.alias("clean_separation"),
        F.when(ok, F.when(inside, r).otherwise(mid)).otherwise(F.lit(working_id)).alias("rec_min_id"),
        F.when(ok, F.floor("cov_floor").cast("double")).otherwise(F.lit(working_cov)).alias("rec_min_cov"),
    )


def confound_report(df: DataFrame, novelty: str, roles: Mapping[str, str], quantile: float = 0.33, artifact: float = 0.4,
                    redundant: float = 0.85, generalization: float = 0.4) -> DataFrame:
    """(confound, role, n, spearman, low_n, low_spearman, verdict)."""
    out = None
    src = cut(df.select(novelty, *roles))
    for c, role in roles.items():
        sub = cut(src.where(F.col(novelty).isNotNull() & F.col(c).isNotNull()).select(novelty, c))
        row = spearman(sub, novelty, c).select("n", "rho")
        if role == "redundancy":
            at = percentiles(sub, [], c, {"t": quantile}).select("t").scalar()
            low = cut(sub.withColumn("__t", at).where(F.col(c) <= F.col("__t")).drop("__t"))
            lrow = spearman(low, novelty, c)
            row = row.select("n", "rho", lrow.select("n").scalar().alias("low_n"), lrow.select("rho").scalar().alias("low_rho"))
            verdict = (
                F.when(F.abs("rho") > redundant, "redundant-with-identity")
                .when(F.coalesce(F.abs("low_rho") > generalization, F.lit(False)), "low-identity-artifact")
                .otherwise("adds-value")
            )
        else:
            row = row.select("n", "rho", F.lit(None).cast("long").alias("low_n"), F.lit(None).cast("double").alias("low_rho"))
            verdict = F.when(F.abs("rho") > artifact, "artifact-confound").otherwise("clean")
        verdict = F.when(F.col("n") < 3, "insufficient-data").otherwise(verdict)
        row = row.select(F.lit(c).alias("confound"), F.lit(role).alias("role"), "n", F.col("rho").alias("spearman"),
                         "low_n", F.col("low_rho").alias("low_spearman"), verdict.alias("verdict"))
        out = row if out is None else out.unionByName(row)
    return out


def role_gap(a: DataFrame, b: DataFrame, value: str, id_col: str = "id") -> DataFrame:
    """(id, gap): percentile of the id among ``b`` minus its percentile among ``a``."""
    pa = ranked(a, [], value, "r").select(id_col, (F.col("r") / F.col("r_n")).alias("pa"))
    pb = ranked(b, [], value, "r").select(id_col, (F.col("r") / F.col("r_n")).alias("pb"))
    return pa.join(pb, id_col).select(id_col, (F.col("pb") - F.col("pa")).alias("gap"))


def stage_saturation(df: DataFrame, label: str, failed: Column, id_col: str, threshold: float) -> DataFrame:
    """(label, processed, failed, rate, saturated, examples): failures per label and up
    to three failing ids."""
    rows = df.select(F.col(label).alias("label"), F.col(id_col).alias("id"), failed.alias("bad"))
    total = rows.groupBy("label").agg(F.count("*").alias("processed"), F.count_if("bad").alias("failed"))
    first = Window.partitionBy("label").orderBy("id")
    three = rows.where("bad").withColumn("rn", F.row_number().over(first)).where("rn <= 3")
    three = three.groupBy("label").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    rate = F.col("failed") / F.col("processed")
    return total.join(three, "label", "left").select(
        "label", "processed", "failed", rate.alias("rate"), (rate >= threshold).alias("saturated"),
        F.coalesce("examples", F.lit("")).alias("examples"),
    )
