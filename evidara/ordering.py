"""Running aggregates, ranks and percentiles over groups of any size.

``Window.partitionBy(group)`` sends a whole group to one task.  Here the ordered
rows are cut into key ranges first, so a group that holds a third of the table is
spread over many tasks: each range is scanned on its own and the totals of the
earlier ranges are added.  Range borders come from a hash sample of the keys; they
decide balance only, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.session import cut

SAMPLE_PER_RANGE = 16
MIN_RANGES = 8
ROWS_PER_RANGE = 20_000
#: up to so many borders are found by halves, in one compiled expression
TREE_BORDERS = 64
#: more borders than this are sent as data, not as part of the plan
LITERAL_BORDERS = 1024


@dataclass(frozen=True)
class Scan:
    """One running aggregate: ``how`` is sum, min or max over the rows before
    (``"before"``), up to (``"upto"``) or from (``"from"``) the current row."""

    how: str
    value: Column
    rows: str = "before"


_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _merge(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a, b - b) + F.coalesce(b, a - a)
    if how == "min":
        return F.least(a, b)
    return F.greatest(a, b)


def range_limit(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_RANGES, 2 * parts)


def _literal(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType) and value is not None:
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, dtype.fields)])
    return F.lit(value).cast(dtype)


def with_range(df: DataFrame, keys: Sequence[str], ranges: int | None = None, name: str = "__range") -> DataFrame:
    """Number of sampled borders below the row's key; ``df`` must be cheap to read
    twice and ``keys`` unique per row.

    The driver sees the ``SAMPLE_PER_RANGE`` keys per range with the smallest hashes,
    whatever the table size.  How small those hashes are also tells how many rows there
    are, which sets the number of ranges where the caller does not.
    """
    keys = list(keys)
    limit = ranges or range_limit(df)
    sample = df.select(*keys, F.xxhash64(*keys).alias("__key_hash")).orderBy("__key_hash").limit(limit * SAMPLE_PER_RANGE)
    seen = sample.agg(
        F.sort_array(F.collect_list(F.struct(*keys))).alias("ks"), F.max("__key_hash").alias("h")
    ).first()
    ks = seen["ks"] or []
    if ranges is None:
        full = len(ks) == limit * SAMPLE_PER_RANGE
        rows = len(ks) * 2.0**64 / (seen["h"] + 2.0**63 + 1.0) if full else len(ks)
        ranges = max(MIN_RANGES, min(limit, int(rows / ROWS_PER_RANGE)))
    types = {f.name: f.dataType for f in df.select(*keys).schema}
    cuts = [ks[i * len(ks) // ranges] for i in range(1, ranges)] if ks else []
    if not cuts:
        return df.withColumn(name, F.lit(0))

    def border(row):
        return F.struct(*[_literal(v, types[c]).alias(c) for c, v in zip(keys, row)])

    key = F.struct(*keys)

    def below(rows: list, first: int, end: int) -> Column:
        if first == end:
            return F.lit(first)
        mid = (first + end) // 2
        return F.when(border(rows[mid]) < key, below(rows, mid + 1, end)).otherwise(below(rows, first, mid))

    if len(cuts) <= TREE_BORDERS:
        return df.withColumn(name, below(cuts, 0, len(cuts)))
    if len(cuts) > LITERAL_BORDERS:
        # many borders travel as one row: the plan stays small, and their number is not limited
        return _placed(df, keys, cuts, types, name)
    step = max(2, int(ranges**0.5))
    coarse = cuts[step - 1 :: step]
    out = df.withColumn("__block", below(coarse, 0, len(coarse)))
    fine = F.size(F.filter(F.slice(F.array(*[border(r) for r in cuts]), F.col("__block") * step + 1, step), lambda b: b < key))
    return out.withColumn(name, F.col("__block") * step + fine).drop("__block")


def _placed(df: DataFrame, keys: list[str], cuts: list, types: Mapping[str, T.DataType], name: str) -> DataFrame:
    """``df`` with the number of ``cuts`` below its key: blocks of borders by their ends first, then the
    borders of one block.  The borders are one row sent to every task."""
    kind = T.StructType([T.StructField(c, types[c]) for c in keys])
    step = max(2, int(len(cuts) ** 0.5))
    blocks = [[tuple(r) for r in cuts[i : i + step]] for i in range(0, len(cuts), step)]
    schema = T.StructType([T.StructField("__ends", T.ArrayType(kind)), T.StructField("__blocks", T.ArrayType(T.ArrayType(kind)))])
    table = df.sparkSession.createDataFrame([([b[-1] for b in blocks], blocks)], schema)
    key = F.struct(*keys)
    got = df.withColumn("__ends", table.select("__ends").scalar()).withColumn("__blocks", table.select("__blocks").scalar())
    got = got.withColumn("__block", F.size(F.filter("__ends", lambda b: b < key)))
    inside = F.coalesce(F.size(F.filter(F.get("__blocks", F.col("__block")), lambda b: b < key)), F.lit(0))
    return got.withColumn(name, F.col("__block") * step + inside).select(*df.columns, name)


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    scans: Mapping[str, Scan],
    ranges: int | None = None,
    cut_input: bool = True,
) -> DataFrame:
    """Add one column per scan.  ``group + order`` must identify a row; rows are
    read in ascending ``order`` inside each group."""
    if cut_input:
        df = cut(df)
    group, order = list(group), list(order)
    keyed = with_range(df, group + order, ranges)
    part = group + ["__range"]
    totals = keyed.groupBy(*part).agg(
        *[_AGG[s.how](s.value).alias(f"__t_{n}") for n, s in scans.items()]
    )
    # scans from the far end run over the reversed order: a frame that ends at the last
    # row would be evaluated anew for every row
    up = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*group).orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *part,
        *[_AGG[s.how](f"__t_{n}").over(down if s.rows == "from" else up).alias(f"__c_{n}") for n, s in scans.items()],
    )
    inside = Window.partitionBy(*part).orderBy(*order)
    frames = {
        "before": inside.rowsBetween(Window.unboundedPreceding, -1),
        "upto": inside.rowsBetween(Window.unboundedPreceding, 0),
        "from": Window.partitionBy(*part).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0),
    }
    local = keyed.select(
        "*", *[_AGG[s.how](s.value).over(frames[s.rows]).alias(f"__l_{n}") for n, s in scans.items()]
    )
    same = [local[c].eqNullSafe(carry[c]) for c in part]
    out = local.join(carry, same, "left")
    return out.select(
        *[local[c] for c in df.columns],
        *[_merge(s.how, F.col(f"__c_{n}"), F.col(f"__l_{n}")).alias(n) for n, s in scans.items()],
    )


def value_counts(df: DataFrame, group: Sequence[str], value: str, weight: Column | None = None) -> DataFrame:
    """Distinct (group, value) with ``ties``; equal values collapse before any
    ordering, so a value shared by a third of the rows is one row here."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(n.cast("long").alias("ties"))


def positions(df: DataFrame, group: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """(group, value, ties, below, n): how many rows of the group are smaller than
    ``value`` and how many there are."""
    group = list(group)
    counts = cut(value_counts(df, group, value))
    got = running(
        counts, group, [value], {"below": Scan("sum", F.col("ties"))}, ranges, cut_input=False
    ).withColumn("below", F.coalesce("below", F.lit(0)).cast("long"))
    n = counts.groupBy(*group).agg(F.sum("ties").alias("n"))
    if not group:
        return got.withColumn("n", n.scalar())
    return got.join(n, group)


def average_rank(pos: DataFrame) -> Column:
    """Average-tie rank (1 = smallest) from the columns of :func:`positions`."""
    return F.col("below") + (F.col("ties") + 1) / 2


def ranked(
    df: DataFrame, group: Sequence[str], value: str, name: str = "rank", descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` plus its average-tie rank and the size of its group; rows without a
    value are left out (missing does not take a place)."""
    group = list(group)
    src = cut(df.where(F.col(value).isNotNull()).withColumn("__v", -F.col(value) if descending else F.col(value)))
    pos = positions(src, group, "__v", ranges)
    pos = pos.withColumn(name, average_rank(pos)).select(*group, "__v", name, F.col("n").alias(f"{name}_n"))
    return src.join(pos, group + ["__v"]).drop("__v")


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "row_number",
                ranges: int | None = None) -> DataFrame:
    """1..n in ascending ``order`` inside each group (``group + order`` unique)."""
    out = running(df, group, order, {name: Scan("sum", F.lit(1), "upto")}, ranges)
    return out.withColumn(name, F.col(name).cast("long"))


def picked_values(df: DataFrame, group: Sequence[str], value: str, index: Mapping[str, Column],
                  ranges: int | None = None) -> DataFrame:
    """Per group the values at the zero-based places ``index`` (expressions over the
    group size ``n``) of its sorted rows."""
    pos = positions(df, group, value, ranges)
    hits = [
        F.max(F.when((F.col("below") <= at) & (at < F.col("below") + F.col("ties")), F.col(value))).alias(k)
        for k, at in index.items()
    ]
    return pos.groupBy(*group).agg(*hits, F.max("n").alias("n"))


def percentiles(df: DataFrame, group: Sequence[str], value: str, points: Mapping[str, float],
                ranges: int | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation, one column per point."""
    index: dict[str, Column] = {}
    for k, p in points.items():
        at = (F.col("n") - 1) * F.lit(float(p))
        index[f"__lo_{k}"] = F.floor(at)
        index[f"__hi_{k}"] = F.ceil(at)
    got = picked_values(df, group, value, index, ranges)
    cols = []
    for k, p in points.items():
        at = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"__lo_{k}"), F.col(f"__hi_{k}")
        cols.append((lo + (hi - lo) * (at - F.floor(at))).alias(k))
    return got.select(*group, "n", *cols)
