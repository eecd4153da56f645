"""Rank aggregation and weighted scoring over long votes (id, signal, value)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.ordering import ranked, row_numbers
from evidara.session import cut


@dataclass(frozen=True)
class Signal:
    """One evidence signal of a wide table: its value column, the flag that says
    whether it was measured, and whether a high value speaks against."""

    key: str
    column: str | None = None
    flag: str | None = None
    invert: bool = False
    optional_flag: bool = False


# The evidence signals, their availability flags, and the flags whose
# absence means "written before the flag existed" (the signal still votes).
EVIDENCE_SIGNALS = (
    Signal("phylo", None, "has_phylo_data", optional_flag=True),
    Signal("purifying", None, "has_dnds_data", optional_flag=True),
    Signal("positive", None, "has_dnds_data", optional_flag=True),
    Signal("lse_divergence", None, "has_phylo_data", optional_flag=True),
    Signal("lse_nesting_depth", None, "has_lse_nesting_depth_data"),
    Signal("synteny", None, "has_synteny_data"),
    Signal("expression", None, "has_expression_data"),
    Signal("chemosensory_expr", None, "has_chemosensory_expr_data"),
    Signal("gprotein_coexpr", None, "has_gprotein_data"),
    Signal("ecl_divergence", None, "has_ecl_data"),
    Signal("expansion", None, "has_expansion_data"),
    Signal("og_confidence", None, "has_og_confidence_data"),
    Signal("tandem_cluster", None, "has_tandem_cluster_data"),
    Signal("struct_novelty", "struct_novelty", "has_struct_data"),
    Signal("struct_nonchemo_corrob", "struct_nonchemo_corrob", "has_struct_data", invert=True),
    Signal("emb_classA_sim", "emb_classA_sim", "has_emb_data"),
    Signal("emb_nonchemo_sim", "emb_nonchemo_sim", "has_emb_data", invert=True),
    Signal("emb_novelty", "emb_novelty", "has_emb_data"),
    Signal("or_microswitch", "or_microswitch", "has_or_microswitch_data"),
)
# Axes that rest on the orthogroups and are barred while those are untrusted.
ORTHOGROUP_AXES = ("purifying", "positive", "expansion", "og_confidence")


@dataclass(frozen=True)
class VotePolicy:
    """Which signals may not vote: an explicit list wins over zero weights; an empty
    list states nothing; the word ``none`` alone bars nobody."""

    weights: Mapping[str, float] = field(default_factory=dict)
    override: str | None = None
    trust_orthogroups: bool = False

    def zero_weight(self) -> set[str]:
        return {k for k, w in self.weights.items() if float(w) == 0.0}

    def by_policy(self) -> set[str]:
        names = {s.strip() for s in (self.override or "").split(",")} - {""}
        if any(s.lower() == "none" for s in names):
            if len(names) > 1:
                raise ValueError("'none' cannot be combined with signal names")
            return set()
        return names or self.zero_weight()

    def excluded(self) -> set[str]:
        return self.by_policy() | (set() if self.trust_orthogroups else set(ORTHOGROUP_AXES))


def build_ranklists(
    df: DataFrame, signals: Sequence[Signal] = EVIDENCE_SIGNALS, id_col: str = "id",
    excluded: Iterable[str] = (),
) -> DataFrame:
    """Wide evidence table -> votes (id, signal, value), higher is better.

    One pass over the table: every usable signal becomes an array entry and the
    missing ones are dropped before anything is shuffled.
    """
    barred, cols, votes = set(excluded), set(df.columns), []
    for s in signals:
        col = s.column or (f"{s.key}_score_norm" if f"{s.key}_score_norm" in cols else f"{s.key}_score")
        if s.key in barred or col not in cols:
            continue
        value = F.col(col).try_cast("double")
        value = F.when(F.isnan(value), None).otherwise(value)
        if s.flag is not None and s.flag in cols:
            value = F.when(F.col(s.flag), value)
        elif s.flag is not None and not s.optional_flag:
            continue
        if s.invert:
            value = 1.0 - value
        votes.append(F.struct(F.lit(s.key).alias("signal"), value.alias("value")))
    if not votes:
        return df.select(F.col(id_col).alias("id"), F.lit("").alias("signal"), F.lit(0.0).alias("value")).limit(0)
    return (
        df.select(F.col(id_col).alias("id"), F.explode(F.array(*votes)).alias("v"))
        .select("id", "v.signal", "v.value")
        .where(F.col("value").isNotNull())
    )


def constant_signals(votes: DataFrame) -> DataFrame:
    """Signals whose voters all hold the same value: they vote but cannot rank."""
    return (
        votes.groupBy("signal")
        .agg(F.count("*").alias("n_voters"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .where((F.col("n_voters") > 1) & (F.col("lo") == F.col("hi")))
        .select("signal", "n_voters")
    )


def normalized_ranks(votes: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """(id, signal, r): average-tie rank over the signal's voters divided by their
    number, so the best id gets the smallest r."""
    got = ranked(votes, ["signal"], "value", "rank", descending=higher_is_better)
    return got.select("id", "signal", (F.col("rank") / F.col("rank_n")).alias("r"))


def normalize_group_names(groups: Mapping[str, str]) -> dict[str, str]:
    """Signal keys instead of column names: a ``_score`` ending goes."""
    return {k.removesuffix("_score"): v for k, v in groups.items()}


def fuse_lists(ranks: DataFrame, groups: Mapping[str, str] | None = None) -> DataFrame:
    """Signals of one group cast a single vote: the mean of their normalized ranks."""
    if not groups:
        return ranks.withColumnRenamed("signal", "list")
    pairs = F.create_map(*[F.lit(x) for kv in normalize_group_names(groups).items() for x in kv])
    named = ranks.withColumn("list", F.coalesce(F.try_element_at(pairs, F.col("signal")), F.col("signal")))
    return named.groupBy("id", "list").agg(F.avg("r").alias("r"))


def least_tail(r: np.ndarray) -> np.ndarray:
    """Per row of sorted ranks the least P(k-th smallest of m uniforms <= r_k), at most 1: binomial tails, summed from
    j = m down to k so that each coefficient follows from the one before."""
    m, low = r.shape[1], np.ones(len(r))
    for k in range(1, m + 1):
        x, total, c = r[:, k - 1], np.zeros(len(r)), 1.0
        for j in range(m, k - 1, -1):
            total = total + c * x**j * (1.0 - x) ** (m - j)
            c = c * j / (m - j + 1)
        low = np.minimum(low, total)
    return low


@F.pandas_udf(T.DoubleType())
def _rho(ranks: pd.Series) -> pd.Series:
    sizes, out = ranks.map(len).to_numpy(), np.ones(len(ranks))
    for m in np.unique(sizes[sizes > 0]):
        rows = sizes == m
        out[rows] = least_tail(np.sort(np.stack(ranks[rows].to_numpy()), axis=1))
    return pd.Series(out, index=ranks.index)


def rho_from_lists(lists: DataFrame, keys: Sequence[str] = ("id",), names: Sequence[str] | None = None) -> DataFrame:
    """(keys, rho, m) from (keys, list, r); one entry per list, so the array per id
    is as long as the number of signals.  ``names``: all lists, where no key has two rows of one list; they are
    then collected as columns of fixed width, which needs no sort."""
    if names is None:
        got = lists.groupBy(*keys).agg(F.collect_list("r").alias("rs"), F.count("*").cast("int").alias("m"))
    else:
        got = lists.groupBy(*keys).agg(*[F.max(F.when(F.col("list") == s, F.col("r"))).alias(f"__{i}") for i, s in enumerate(names)],
                                       F.count("*").cast("int").alias("m"))
        got = got.withColumn("rs", F.array_compact(F.array(*[f"__{i}" for i in range(len(names))])))
    return got.select(*keys, _rho("rs").alias("rho"), "m")


def rho_from_arrays(rows: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """(keys, rho, m) from (keys, rs), an id's ranks as an array in any order."""
    return rows.select(*keys, _rho("rs").alias("rho"), F.size("rs").alias("m"))


def rho_statistic(votes: DataFrame, groups: Mapping[str, str] | None = None) -> DataFrame:
    return rho_from_lists(fuse_lists(normalized_ranks(votes), groups))


def null_pvalues(rho: np.ndarray, m: int) -> np.ndarray:
    """P(some order statistic of m uniforms has a score of at most rho), all rows at once.

    Let ``c_k`` be the place where the k-th order statistic has score rho; the places rise with
    k.  If the k-th is the last one at or below its place, exactly k points lie below ``c_k`` and the
    other m - k stay clear of theirs; call the chance of the latter, given where the k are,
    ``clear[k]``.  Summing over the last place gives both
    ``p = sum_k C(m, k) c_k^k clear[k]`` and, for the points above ``c_i`` alone,
    ``clear[i] = 1 - sum_{k>i} C(m-i, k-i) c_k^(k-i) clear[k]``, with ``clear[m] = 1``.
    The sum for p has only positive terms, so tiny p-values keep their digits.
    """
    rho = np.asarray(rho, dtype=float)
    x = np.where((rho > 0) & (rho < 1), rho, 0.5)
    places = np.maximum.accumulate([_score_inverse(x, k, m) for k in range(1, m + 1)], axis=0)
    clear = {m: np.ones(x.shape)}
    for i in range(m - 1, 0, -1):
        last = [math.comb(m - i, k - i) * places[k - 1] ** (k - i) * clear[k] for k in range(i + 1, m + 1)]
        clear[i] = np.clip(1.0 - np.sum(last, axis=0), 0.0, 1.0)
    p = np.sum([math.comb(m, k) * places[k - 1] ** k * clear[k] for k in range(1, m + 1)], axis=0)
    return np.where(rho <= 0, 0.0, np.where(rho >= 1, 1.0, np.minimum(p, 1.0)))


def _score_inverse(score: np.ndarray, k: int, m: int) -> np.ndarray:
    """Place u with P(at least k of m uniforms below u) = score: Newton steps on log u inside a
    bracket, halving it where a step leaves it."""
    lo, hi = np.full(score.shape, -745.0), np.zeros(score.shape)
    at = np.clip((np.log(score) - math.log(math.comb(m, k))) / k, -744.0, -1e-12)
    for _ in range(100):
        u = np.exp(at)
        have = sum(math.comb(m, j) * u**j * (1 - u) ** (m - j) for j in range(k, m + 1))
        lo, hi = np.where(have < score, at, lo), np.where(have < score, hi, at)
        slope = k * math.comb(m, k) * u**k * (1 - u) ** (m - k)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = at - (have - score) / slope
        inside = np.isfinite(step) & (step > lo) & (step < hi)
        moved = np.where(inside, step, (lo + hi) / 2)
        if np.abs(moved - at).max(initial=0.0) < 1e-15:
            break
        at = moved
    return np.exp(at)


@F.pandas_udf(T.DoubleType())
def _null_pvalue(rho: pd.Series, m: pd.Series) -> pd.Series:
    out = pd.Series(np.ones(len(rho)), index=rho.index)
    for size, part in rho.groupby(m):
        out.loc[part.index] = null_pvalues(part.to_numpy(), int(size))
    return out


def rra_from_rho(rho: DataFrame) -> DataFrame:
    """Adds ``score``; the null is computed once per distinct (rho, m)."""
    distinct = rho.select("rho", "m").distinct().withColumn("score", _null_pvalue("rho", "m"))
    return rho.join(distinct, ["rho", "m"])


def rra_score(votes: DataFrame, groups: Mapping[str, str] | None = None) -> DataFrame:
    """(id, rho, m, score), lower is better."""
    rho = cut(rho_statistic(votes, groups))
    return rra_from_rho(rho).select("id", "rho", "m", "score")


def rrf_score(votes: DataFrame, k: float = 60.0, groups: Mapping[str, str] | None = None) -> DataFrame:
    """(id, score): sum of 1 / (k + rank) over the fused lists, higher is better."""
    if groups:
        lists = fuse_lists(normalized_ranks(votes), groups)
        got = ranked(lists, ["list"], "r", "rank")
    else:
        got = ranked(votes, ["signal"], "value", "rank", descending=True)
    return got.groupBy("id").agg(F.sum(1.0 / (F.lit(k) + F.col("rank"))).alias("score"))


def aggregate_order(votes: DataFrame, method: str = "rra", groups: Mapping[str, str] | None = None) -> DataFrame:
    """(id, score, place): best first, ties by id."""
    if method == "rra":
        got = rra_score(votes, groups).select("id", "score", F.col("score").alias("__o"))
    elif method == "rrf":
        got = rrf_score(votes, groups=groups).select("id", "score", (-F.col("score")).alias("__o"))
    else:
        raise ValueError(f"unknown method {method!r}: use 'rra' or 'rrf'")
    return row_numbers(got, [], ["__o", "id"], "place").drop("__o")


def tied_block_size(scores: DataFrame, score: str = "score") -> DataFrame:
    """``scores`` plus how many rows share the row's exact score."""
    ties = scores.groupBy(score).agg(F.count("*").alias("tied_block_size"))
    return scores.join(ties, score)


def fair_score(
    scores: Mapping[str, Column], weights: Mapping[str, float], floor: float = 0.4,
    reliability: Column | None = None, shrunk_axes: Iterable[str] = ("positive", "purifying"),
) -> tuple[Column, Column]:
    """(score, completeness) column expressions: weighted mean over the measured
    axes times the measured share of weight (at least ``floor``)."""
    shrunk = set(shrunk_axes)
    trust = F.lit(1.0) if reliability is None else F.greatest(F.lit(0.0), F.least(F.lit(1.0), reliability))
    total = present = summed = F.lit(0.0)
    for axis, weight in weights.items():
        w = F.lit(max(float(weight), 0.0))
        w = w * trust if axis in shrunk else w
        total = total + w
        x = scores.get(axis)
        if x is None:
            continue
        ok = x.isNotNull() & ~F.isnan(x)
        present = present + F.when(ok, w).otherwise(0.0)
        summed = summed + F.when(ok, w * x).otherwise(0.0)
    some = (total > 0) & (present > 0)
    share = F.when(some, F.greatest(F.lit(float(floor)), present / total)).otherwise(0.0)
    return F.when(some, summed / present * share).otherwise(0.0), share


def minmax_normalize(df: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """(x - min) / (max - min) over the whole table, 0 where all values agree."""
    ends = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]
    )
    lo = {c: ends.select(f"lo_{c}").scalar() for c in columns}
    hi = {c: ends.select(f"hi_{c}").scalar() for c in columns}
    return df.select(
        "*",
        *[
            F.when(hi[c] - lo[c] > 0, (F.col(c) - lo[c]) / (hi[c] - lo[c])).otherwise(F.lit(0.0)).alias(c + suffix)
            for c in columns
        ],
    )


def confidence_tier(completeness: Column, score: Column, best: float = 1.0) -> Column:
    share = score / F.lit(best)
    return (
        F.when((completeness >= 0.6) & (share >= 0.5), "High")
        .when((completeness >= 0.4) | (share >= 0.3), "Medium")
        .otherwise("Low")
    )


def evidence_completeness(flags: Sequence[Column]) -> Column:
    """Share of the live evidence sources that are present."""
    if not flags:
        return F.lit(0.0)
    total = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    return total / F.lit(float(len(flags)))


def final_rank(df: DataFrame, order: DataFrame | None = None, id_col: str = "id", score: str = "rank_score") -> DataFrame:
    """``df`` plus ``final_rank`` 1..n.  With ``order`` (id, place) its ids come first
    and the rest follow in the order of ``score`` descending, then id."""
    if order is None:
        got = df.withColumn("__a", F.lit(0)).withColumn("__b", -F.col(score))
    else:
        at = order.select(F.col("id").alias(id_col), F.col("place").cast("double").alias("__p"))
        got = (
            df.join(at, id_col, "left")
            .withColumn("__a", F.col("__p").isNull().cast("int"))
            .withColumn("__b", F.coalesce("__p", -F.col(score)))
            .drop("__p")
        )
    return row_numbers(got, [], ["__a", "__b", id_col], "final_rank").drop("__a", "__b")


def fused_rank(df: DataFrame, scores: DataFrame, id_col: str = "id", weighted: str = "rank_score") -> DataFrame:
    """``df`` plus ``rra_score``, ``rra_tied_block_size`` and ``final_rank``: rows with a fused score
    (``scores``: id, score) by it, then id; the others follow in the weighted order with block size 0."""
    ties = scores.groupBy("score").agg(F.count("*").alias("__t"))
    told = scores.join(ties, "score").select(F.col("id").alias(id_col), F.col("score").alias("rra_score"), "__t")
    got = df.join(told, id_col, "left").withColumn("rra_tied_block_size", F.coalesce("__t", F.lit(0)).cast("long")).drop("__t")
    got = got.withColumn("__a", F.col("rra_score").isNull().cast("int")).withColumn("__b", F.coalesce("rra_score", -F.col(weighted)))
    return row_numbers(got, [], ["__a", "__b", id_col], "final_rank").drop("__a", "__b")


def saturation_report(votes: DataFrame, groups: Mapping[str, str] | None = None, digits: int | None = None) -> DataFrame:
    """How much of the fused order of ``votes`` rests on ties: one row of counts and shares over the scores of
    :func:`rra_score`, rounded to ``digits`` where given."""
    score = "score"
    scores = rra_score(votes, groups).select(score if digits is None else F.round(score, digits).alias(score))
    ties = scores.groupBy(score).agg(F.count("*").alias("c"))
    n = F.sum("c")
    return ties.agg(
        n.alias("n_candidates"),
        F.sum(F.when(F.col(score) >= 1.0, F.col("c")).otherwise(0)).alias("n_saturated"),
        (F.sum(F.when(F.col(score) >= 1.0, F.col("c")).otherwise(0)) / n).alias("fraction_saturated"),
        F.max("c").alias("largest_tie_block"),
        F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("n_tied"),
        (F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)) / n).alias("fraction_tied"),
        F.count("*").alias("n_distinct_scores"),
    )


def rank_average_consensus(votes: DataFrame) -> DataFrame:
    """(id, consensus): mean over lists of 1 - normalized rank."""
    return normalized_ranks(votes).groupBy("id").agg(F.avg(1.0 - F.col("r")).alias("consensus"))


def plurality(df: DataFrame, key: Sequence[str], label: str) -> DataFrame:
    """Most frequent label per key, ties by alphabet.  Two-step count, no group list."""
    votes = df.groupBy(*key, label).agg(F.count("*").alias("n"))
    return votes.groupBy(*key).agg(F.min(F.struct((-F.col("n")).alias("o"), F.col(label))).alias("w")).select(
        *key, F.col(f"w.{label}").alias(label), (-F.col("w.o")).alias("n_votes")
    )


def reliability_shrink(df: DataFrame, value: str, reliability: str, neutral: Column) -> Column:
    """value * w + neutral * (1 - w), w clamped to [0, 1], missing w = 1."""
    w = F.coalesce(F.when(~F.isnan(F.col(reliability)), F.col(reliability)), F.lit(1.0))
    w = F.greatest(F.lit(0.0), F.least(F.lit(1.0), w))
    return F.col(value) * w + neutral * (1.0 - w)
