"""Quotas, caps and seeded samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.operators.stats import draw, uniform
from evidara.ordering import Scan, row_numbers, running
from evidara.session import cut

def _weight(weight: Mapping, on: str) -> Column:
    pairs = [x for k, v in weight.items() for x in (F.lit(k), F.lit(float(v)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(on)), F.lit(1.0)) if pairs else F.lit(1.0)


def allocate_quotas(counts: DataFrame, bins: Sequence[str], weight: Column, target: int) -> DataFrame:
    """``counts`` (bins, n) with ``quota``: slots in proportion to n x weight, at least one each.

    What is too much leaves the lightest bins first (down to one), what is missing goes to the
    heaviest first (up to n); ties in the order of the bins.  Room and need are running sums over
    the bins, so their number is not limited.
    """
    bins = list(bins)
    base = cut(counts.withColumn("__w", weight.cast("double")).withColumn("__mass", F.col("n") * F.col("__w")))
    sums = base.agg(F.sum("n").alias("n"), F.sum("__mass").alias("mass"))
    share = F.greatest(F.lit(1), F.floor(F.col("__mass") / sums.select("mass").scalar() * target)).cast("long")
    base = cut(base.withColumn("__b", share).withColumn("__down", F.col("__b") - 1).withColumn(
        "__up", F.greatest(F.lit(0), F.col("n") - F.col("__b"))).withColumn("__light", F.col("__w")).withColumn("__heavy", -F.col("__w")))
    gap = F.lit(target) - base.agg(F.sum("__b").alias("b")).scalar()
    trimmed = running(base, [], ["__light", *bins], {"__below": Scan("sum", F.col("__down"))}, cut_input=False)
    filled = running(cut(trimmed), [], ["__heavy", *bins], {"__above": Scan("sum", F.col("__up"))}, cut_input=False)
    down = F.least(F.col("__down"), F.greatest(F.lit(0), -gap - F.coalesce("__below", F.lit(0))))
    up = F.least(F.col("__up"), F.greatest(F.lit(0), gap - F.coalesce("__above", F.lit(0))))
    quota = F.when(sums.select("n").scalar() <= target, F.col("n")).when(gap < 0, F.col("__b") - down).otherwise(F.col("__b") + up)
    return filled.select(*bins, "n", quota.cast("long").alias("quota"))


def quota_subsample(df: DataFrame, bins: Sequence[str], weight: Mapping[str, float], weight_on: str, order: Sequence[Column],
                    target: int) -> DataFrame:
    """First rows of each bin (by ``order``) up to its quota (see :func:`allocate_quotas`)."""
    bins = list(bins)
    quota = allocate_quotas(df.groupBy(*bins).agg(F.count("*").alias("n")), bins, _weight(weight, weight_on), target)
    names = [f"__o{i}" for i in range(len(order))]
    ranked = row_numbers(df.select("*", *[o.alias(n) for o, n in zip(order, names)]), bins, names, "__k")
    quota = quota.select(*[F.col(b).alias(f"__q{b}") for b in bins], F.col("quota").alias("__quota"))
    same = [F.col(b).eqNullSafe(F.col(f"__q{b}")) for b in bins]
    return ranked.join(quota, same).where(F.col("__k") <= F.col("__quota")).select(*df.columns)


def backbone_selection(df: DataFrame, quota: int, invertebrate: Column) -> DataFrame:
    """Per family up to ``quota``: one invertebrate first, then one of each subfamily in
    turn (others before invertebrates, then accession).
    ``df``: family, subfamily, species, accession."""
    rows = cut(df.withColumn("__inv", invertebrate))
    lead = rows.where("__inv").groupBy("family").agg(F.min_by("accession", F.struct("species", "accession")).alias("__lead"))
    rows = rows.join(lead, "family", "left").withColumn("__first", F.coalesce(F.col("accession") == F.col("__lead"), F.lit(False)))
    rest = rows.where(~F.col("__first"))
    turn = Window.partitionBy("family", "subfamily").orderBy("__inv", "accession")
    # a place beyond the quota cannot be reached, so each subfamily gives at most `quota` rows
    rest = rest.withColumn("__turn", F.row_number().over(turn)).where(F.col("__turn") <= quota)
    both = rows.where("__first").withColumn("__turn", F.lit(0)).unionByName(rest)
    seat = Window.partitionBy("family").orderBy("__turn", "subfamily", "accession")
    got = both.withColumn("__seat", F.row_number().over(seat)).where(F.col("__seat") <= quota)
    return got.select(*df.columns)


def allocate_species(counts: DataFrame, species: str, budget: int, floor: int, cap: int, must: Sequence, weight: Column, seed: int) -> DataFrame:
    """``counts`` (species, n) with ``take``: ``floor`` records each, wanted species to the ``cap``.

    Beyond the budget the largest lose one at a time, over and over, until it is met.  What the
    budget has left is drawn by weight, one record at a time: slot j of a species comes up after j
    exponential waiting times of rate ``weight``, and the earliest slots are taken, which is the same
    as drawing species by weight until they are full.
    """
    top = F.least(F.lit(cap), F.col("n")).cast("long")
    base = counts.withColumn("__top", top).withColumn("__a", F.when(F.col(species).isin(list(must)), top).otherwise(F.least(F.lit(floor), top)))
    base = cut(base.withColumn("__w", F.greatest(F.lit(0.0), weight.cast("double"))))
    over = base.agg(F.sum("__a")).first()[0] or 0
    if over > budget:
        # rows of levels are at most the cap; after r rounds what lies above level r is left
        levels = base.select(F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(F.col("__a"), F.lit(1)))).alias("l"), "__a").where("__a >= l").groupBy("l").count()
        above, rounds = over, 0
        for row in levels.orderBy("l").collect():
            if above - row["count"] < budget:
                break
            above, rounds = above - row["count"], row["l"]
        lowered = base.withColumn("__a", F.greatest(F.lit(0), F.col("__a") - rounds)).withColumn("__o", -F.col("__a"))
        place = row_numbers(lowered, [], ["__o", species], "__k")
        return place.select(species, "n", (F.col("__a") - ((F.col("__k") <= above - budget) & (F.col("__a") > 0)).cast("int")).alias("take"))
    room = base.where("__a < __top").select(species, "__w", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__top") - F.col("__a"))).alias("__j"))
    wait = room.withColumn("__t", -F.log(1.0 - uniform(seed, F.col(species), F.col("__j"))) / F.when(F.col("__w") > 0, F.col("__w")).otherwise(1.0))
    due = running(wait, [species], ["__j"], {"__due": Scan("sum", F.col("__t"), "upto")})
    won = due.withColumn("__zero", F.col("__w") <= 0).orderBy("__zero", "__due", species, "__j").limit(budget - over)
    more = won.groupBy(F.col(species).alias("__s")).agg(F.count("*").alias("__more"))
    return base.join(more, F.col(species).eqNullSafe(F.col("__s")), "left").select(species, "n", (F.col("__a") + F.coalesce("__more", F.lit(0))).alias("take"))


def balanced_sample(df: DataFrame, species: str, id_col: str, budget: int, floor: int, cap: int, must: Sequence, weight: Mapping[str, float],
                    seed: int = 0) -> DataFrame:
    """At most ``budget`` records, balanced over species (see :func:`allocate_species`); the records
    of a species are drawn by a seeded hash."""
    counts = df.groupBy(species).agg(F.count("*").alias("n"))
    take = allocate_species(counts, species, budget, floor, cap, must, _weight(weight, species), seed)
    take = cut(take.select(F.col(species).alias("__s"), F.col("take").alias("__take")))
    drawn = row_numbers(df.withColumn("__h", draw(seed, F.col(id_col))), [species], ["__h", id_col], "__k")
    return drawn.join(take, F.col(species).eqNullSafe(F.col("__s"))).where(F.col("__k") <= F.col("__take")).select(*df.columns)


def stratified_frame(df: DataFrame, key: str, best: Sequence[Column], gates: Column, strata: str, n: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(sample, composition): one row per key, gated, ``n`` drawn at random by hash;
    composition compares strata of frame and sample."""
    rest = [c for c in df.columns if c != key]
    one = df.where(gates).groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*[b.alias(f"b{i}") for i, b in enumerate(best)])).alias("r"))
    frame = cut(one.select(key, *[F.col(f"r.{c}").alias(c) for c in rest]))
    sample = cut(frame.withColumn("__h", draw(seed, F.col(key))).orderBy("__h", key).limit(n).drop("__h"))
    a = frame.groupBy(strata).agg(F.count("*").alias("in_frame"))
    b = sample.groupBy(strata).agg(F.count("*").alias("in_sample"))
    return sample, a.join(b, strata, "left").fillna(0, ["in_sample"])


def shard_assign(df: DataFrame, order: Sequence[str], shards: int) -> DataFrame:
    """Record position modulo the number of shards."""
    got = row_numbers(df, [], list(order), "__k")
    return got.withColumn("shard", F.pmod(F.col("__k") - 1, F.lit(shards)).cast("int")).drop("__k")


RANKS = ("order", "class", "phylum")


def greedy_spread(df: DataFrame, family: str, held: DataFrame | None, per_order: int) -> DataFrame:
    """(family, id, pick, gain_order, gain_class, gain_phylum): per family, one after the other, the
    record that brings most ranks (order, class, phylum) that are new to the family, counting what it
    holds; more new orders first on ties, then classes, phyla, then the smaller id.  At most ``per_order``
    records of one order; it ends when nothing new is left.

    ``df``: family, id, phylum, class, order (blank or null: unranked, never new); ``held``: family, rank, name.
    A lineage brings nothing twice, so only its first record takes part: one task gets the
    lineages of a family, not its records.
    """
    lineage = [F.coalesce(F.col(r), F.lit("")).cast("string").alias(r) for r in RANKS]
    rows = df.select(family, "id", *lineage).groupBy(family, *RANKS).agg(F.min("id").alias("id"))
    if held is not None:
        known = held.groupBy(F.col(family).alias("__f")).agg(F.collect_set(F.struct("rank", F.col("name").cast("string").alias("name"))).alias("held"))
        rows = rows.join(known, F.col(family) == F.col("__f"), "left").drop("__f")
    else:
        rows = rows.withColumn("held", F.lit(None).cast("array<struct<rank:string,name:string>>"))
    fields = [df.schema[family], df.schema["id"]] + [T.StructField(n, T.IntegerType()) for n in ("pick", *(f"gain_{r}" for r in RANKS))]

    def pick(pdf):
        import pandas as pd

        left = pdf.sort_values("id").to_dict("records")
        seen = {r: {""} for r in RANKS}
        for h in left[0]["held"] if left[0]["held"] is not None else []:
            seen.get(h["rank"], set()).add(h["name"])
        taken, out = {}, []
        while True:
            open_ = [r for r in left if taken.get(r["order"], 0) < per_order]
            gains = [tuple(int(r[k] not in seen[k]) for k in RANKS) for r in open_]
            best = max(range(len(open_)), key=lambda i: (sum(gains[i]), *gains[i], -i), default=None)
            if best is None or not any(gains[best]):
                break
            row = open_[best]
            for k in RANKS:
                seen[k].add(row[k])
            taken[row["order"]] = taken.get(row["order"], 0) + 1
            out.append((row[family], row["id"], len(out) + 1, *gains[best]))
        return pd.DataFrame(out, columns=[f.name for f in fields])

    return rows.groupBy(family).applyInPandas(pick, T.StructType(fields))


def anchor_set(tiers: Sequence[DataFrame], cap: int) -> DataFrame:
    """Union of tiers, one row per accession from the strongest tier, and per subfamily at
    most ``cap`` rows taken in turn over organisms.  tier: accession, subfamily, organism."""
    stacked = None
    for i, df in enumerate(tiers):
        part = df.select("accession", "subfamily", "organism", F.lit(i).alias("tier"))
        stacked = part if stacked is None else stacked.unionByName(part)
    one = stacked.groupBy("accession").agg(F.min(F.struct("tier", "subfamily", "organism")).alias("r")).select("accession", "r.*")
    turn = Window.partitionBy("subfamily", "organism").orderBy("tier", "accession")
    seat = Window.partitionBy("subfamily").orderBy("__turn", "organism", "accession")
    got = one.withColumn("__turn", F.row_number().over(turn)).where(F.col("__turn") <= cap)
    return got.withColumn("__seat", F.row_number().over(seat)).where(F.col("__seat") <= cap).drop("__turn", "__seat")
