"""Mixing of sources to target weights: iterative proportional fitting of token weights.

Documents count in cells of source, language and topic.  The tokens of the cells are raked to
the target share of every source, language and topic in turn until all three fit; a document of a
cell is then drawn with a probability in proportion to the cell's factor.  Everything is DataFrame
work: one pass counts the cells, the raking runs on the cell table, one pass draws.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.llm.common import ascii_lower
from evidara.ordering import Scan, running
from evidara.session import cut

SIDES = ("source", "lang", "topic")
#: target share of a value: its share of tokens to this power, normalised; 1 keeps the corpus, 0 levels it
TEMPERING: Mapping[str, float] = {"source": 0.7, "lang": 0.7, "topic": 0.5}
#: expected share of the corpus' tokens in the sample
BUDGET = 0.5
TOPICS = 8
#: sweeps between two cuts of the lineage; raking ends when no side is off by more than TOLERANCE, or
#: when a round of sweeps takes less than the share STALL off the error
SWEEPS, TOLERANCE, STALL = 6, 1e-6, 0.01
SEED = 42
#: a table of up to so many cells goes to every task, and is raked in one
BROADCAST_CELLS = 200_000


def word_count(text: Column) -> Column:
    """Runs of other characters than ASCII white space."""
    words = F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ")
    return F.coalesce(F.when(F.length(F.trim(F.translate(text, "\t\n\x0b\f\r", "     "))) > 0, F.size(words)), F.lit(0)).cast("long")


def vocabulary_topic(text: Column, topics: int = TOPICS) -> Column:
    """Topic of a text that has none: the bucket of the last of its words in alphabetical order,
    so texts with the same rare vocabulary tend to share it."""
    top = F.array_max(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"))
    return F.concat(F.lit("t"), F.pmod(F.xxhash64(F.coalesce(top, F.lit(""))), F.lit(topics)))


def _keys(docs: DataFrame, topic: Column | None) -> dict[str, Column]:
    """Cell of a row; null values are a value of their own."""
    none = F.lit("(none)")
    return {
        "__source": F.coalesce(F.col("source"), none), "__lang": F.coalesce(F.col("lang"), none),
        "__topic": F.coalesce((vocabulary_topic(F.col("text")) if topic is None else topic).cast("string"), none),
        "__tokens": word_count(F.col("text")),
    }


def _targets(cells: DataFrame, side: str, wish: float | Mapping[str, float]) -> DataFrame:
    """(side, target): share of tokens of each value that has any."""
    sums = cells.groupBy(side).agg(F.sum("tokens").alias("t"))
    if isinstance(wish, Mapping):
        given = F.coalesce(*[F.when(F.col(side) == k, F.lit(float(v))) for k, v in wish.items()], F.lit(0.0)) if wish else F.lit(0.0)
    else:
        given = F.pow(F.col("t").cast("double"), F.lit(float(wish)))
    share = sums.select(side, given.alias("g"))
    total = share.agg(F.sum("g").alias("all")).scalar()
    return share.select(F.col(side), F.try_divide(F.col("g"), total).alias(f"target_{side}"))


def _off(cells: DataFrame, sides: list[str]) -> float:
    """Largest distance of a value's share of the weight from its target."""
    whole = cells.agg(F.sum("tokens").cast("double").alias("w")).scalar()
    gaps = [cells.groupBy(side).agg(F.sum("weight").alias("w"), F.first(f"target_{side}").alias("t")).select(
        F.abs(F.try_divide(F.col("w"), whole) - F.col("t")).alias("off")) for side in sides]
    together = gaps[0]
    for more in gaps[1:]:
        together = together.unionByName(more)
    return together.agg(F.max("off")).first()[0] or 0.0


def _sweeps_in_one_task(cells: DataFrame, sides: list[str]) -> DataFrame:
    """SWEEPS sweeps over a table that one task holds, in one stage."""
    for _ in range(SWEEPS):
        for side in sides:
            now = F.sum("weight").over(Window.partitionBy(side))
            cells = cells.withColumn("weight", F.coalesce(F.try_divide(F.col("weight") * F.col(f"target_{side}") * F.col("__sum"), now), F.lit(0.0)))
    return cut(cells)


def _sweep_spread(cells: DataFrame, sides: list[str]) -> DataFrame:
    """One sweep over a table of any size: sums by value with partial sums in every task, joined back."""
    for side in sides:
        sums = cells.groupBy(side).agg(F.sum("weight").alias("__now"))
        got = cells.join(sums, side, "left")
        fitted = F.coalesce(F.try_divide(F.col("weight") * F.col(f"target_{side}") * F.col("__sum"), F.col("__now")), F.lit(0.0))
        cells = cut(got.withColumn("weight", fitted).select(*cells.columns))
    return cells


def rake(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TEMPERING, one_task: int = BROADCAST_CELLS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, the token weight that gives each side
    its target shares (the weights sum to the tokens), and ``raking_error``, the largest distance of a
    value's share from its target that is left.

    Sweeps go on until the error is at most TOLERANCE or has stopped falling.  Where no exact fit exists (a
    target on a combination without tokens) it stops falling, and the weights are those
    after the last sweep, exact on the last side.  A table of up to ``one_task`` cells is raked in one
    task; a larger one is summed and joined by Spark, with the same steps.
    """
    sides = list(targets)
    got = cells.where("tokens > 0")
    for side, wish in targets.items():
        got = got.join(_targets(cells.where("tokens > 0"), side, wish), side)
    whole = cells.where("tokens > 0").agg(F.sum("tokens").cast("double").alias("w")).scalar()
    got = cut(got.withColumn("weight", F.col("tokens").cast("double")).withColumn("__sum", whole))
    small = got.count() <= one_task
    if small:
        got = got.coalesce(1)
    before = off = float("inf")
    while sides:
        if small:
            got = _sweeps_in_one_task(got, sides)
        else:
            for _ in range(SWEEPS):
                got = _sweep_spread(got, sides)
        before, off = off, _off(got, sides)
        if off <= TOLERANCE or off > (1 - STALL) * before:
            break
    return got.select(*cells.columns, "weight", F.lit(off if sides else 0.0).alias("raking_error"))


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``cells`` with ``probability``: the factor weight / tokens of the cell times one constant,
    at most 1, such that ``budget`` of all tokens are expected in the sample (all that has weight,
    if that is less).

    With the factors in falling order, the cells before some place are taken whole and the rest
    shares what is left; the place is the first whose share stays below 1.  Cells of one factor count
    as one row, and the rows are added up in ranges.
    """
    f = cut(cells.withColumn("__f", F.col("weight") / F.col("tokens")))
    steps = cut(f.groupBy((-F.col("__f")).alias("down")).agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")))
    every = steps.agg(F.sum("tokens").cast("double").alias("t"), F.sum("weight").alias("w")).first()
    order = running(steps, [], ["down"], {"whole": Scan("sum", F.col("tokens")), "gone": Scan("sum", F.col("weight"))}, cut_input=False)
    want = F.lit(float(budget) * (every["t"] or 0.0))
    c = F.try_divide(want - F.coalesce("whole", F.lit(0)), F.lit(every["w"] or 0.0) - F.coalesce("gone", F.lit(0.0)))
    pick = order.select((-F.col("down")).alias("f"), c.alias("c")).where("f > 0 AND c * f <= 1").agg(F.max(F.struct("f", "c"))["c"]).first()[0]
    shared = F.lit(1.0) if pick is None else F.least(F.lit(1.0), F.lit(max(pick, 0.0)) * F.col("__f"))
    return f.select(*cells.columns, F.when(F.col("__f") <= 0, 0.0).otherwise(shared).alias("probability"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) fixed by the document's id and the seed."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11).cast("double") / float(1 << 53)


def _decide(docs: DataFrame, targets, budget: float, topic: Column | None, seed: int) -> DataFrame:
    """``docs`` with the cell (``__source``, ``__lang``, ``__topic``, ``__tokens``), ``__weight`` of the document's
    tokens, ``__p`` and ``__taken``."""
    keys = _keys(docs, topic)
    counted = docs.select(*[c.alias(k) for k, c in keys.items()]).groupBy("__source", "__lang", "__topic").agg(F.sum("__tokens").alias("tokens"))
    cells = cut(counted.toDF(*SIDES, "tokens"))
    fitted = probabilities(rake(cells, targets), budget).select(
        *[F.col(s).alias(f"__{s}") for s in SIDES], (F.col("weight") / F.col("tokens")).alias("__factor"), F.col("probability").alias("__p"), F.col("raking_error").alias("__error"))
    fitted = cut(fitted)
    # the documents stay where they are unless there are very many cells
    fitted = F.broadcast(fitted) if fitted.count() <= BROADCAST_CELLS else fitted
    got = docs.withColumns(keys).join(fitted, [f"__{s}" for s in SIDES], "left")
    # a text without tokens weighs nothing, whatever is decided about it
    got = got.withColumn("__p", F.coalesce("__p", F.lit(0.0))).withColumn("__weight", F.coalesce(F.col("__factor") * F.col("__tokens"), F.lit(0.0)))
    return got.withColumn("__taken", draw(F.col("doc_id"), seed) < F.col("__p"))


def mixture(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TEMPERING, budget: float = BUDGET,
            topic: Column | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, selected, raking_error), one row per row
    of ``docs`` (doc_id, text, source, lang).

    ``targets``: per side a power of the token shares or a share for each value (values not
    named get 0).  ``topic``: a column, or else the bucket of the vocabulary.  ``weight`` is the
    raked weight of the document's tokens, ``probability`` its chance, ``selected`` the draw,
    fixed by doc_id and ``seed``.  ``raking_error`` is what :func:`rake` leaves (null in a cell without
    tokens).  Null values of a side are the value ``(none)``.  Null, empty
    and blank texts have no tokens and weight 0; they share their cell's probability (0 in a cell
    without tokens).  Repeated rows of one doc_id and null ids share one draw each; further columns are
    ignored; an empty table gives no rows.
    """
    got = _decide(docs.select("doc_id", "text", "source", "lang") if topic is None else docs, targets, budget, topic, seed)
    return got.select("doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"),
                      F.col("__tokens").alias("n_tokens"), F.col("__weight").alias("weight"), F.col("__p").alias("probability"),
                      F.col("__taken").alias("selected"), F.col("__error").alias("raking_error"))


def sample_mixture(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TEMPERING, budget: float = BUDGET,
                   topic: Column | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` (all columns) that :func:`mixture` selects."""
    return _decide(docs, targets, budget, topic, seed).where("__taken").select(*docs.columns)
