"""Aggregates over every subtree and nearest nodes by contraction of the tree.

A round takes all leaves off and then about a third of the nodes with one child out of their
chains, so a star and a chain alike are gone after a logarithmic number of rounds.  What hangs
between the two ends of a shortened edge travels with the edge.  A pass along the rounds gives
each node the state of its subtree, a pass back gives it the state of the whole tree; rows stay
near nodes × states, never leaves × ancestors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.joins import join_unique
from evidara.session import cut

AT = ["tree", "node"]


@dataclass
class Step:
    """Nodes that go in one pass: tree, node, parent, length and steps of the edge to it; in a
    compression also the one child with its edge."""

    nodes: DataFrame
    compress: bool


def _with_children(left: DataFrame) -> DataFrame:
    kid = F.struct(F.col("node").alias("child"), F.col("dist").alias("child_dist"), F.col("steps").alias("child_steps"))
    kids = left.where("parent IS NOT NULL").groupBy("tree", F.col("parent").alias("node")).agg(F.count("*").alias("n"), F.min(kid).alias("kid"))
    return cut(left.select(*AT, "parent", "dist", "steps").join(kids, AT, "left").select(*AT, "parent", "dist", "steps", "n", "kid.*"))


def contract(edges: DataFrame) -> list[Step]:
    """The steps that reduce each tree to its root."""
    # an edge without a length has length 0
    table = _with_children(edges.select(*AT, "parent", F.coalesce("length", F.lit(0.0)).alias("dist"), F.lit(1).alias("steps")))
    out: list[Step] = []
    while True:
        raked = table.where("n IS NULL AND parent IS NOT NULL")
        if raked.isEmpty():
            return out
        out.append(Step(raked.select(*AT, "parent", "dist", "steps"), False))
        table = _with_children(table.where("n IS NOT NULL OR parent IS NULL"))
        chain = table.where("n = 1 AND parent IS NOT NULL").withColumn("p", F.xxhash64(*AT, F.lit(len(out))))
        if chain.isEmpty():
            continue
        # of neighbours in a chain the one with the largest hash goes, so no two go together
        above = chain.select("tree", F.col("node").alias("parent"), F.col("p").alias("pa"))
        below = chain.select("tree", F.col("node").alias("child"), F.col("p").alias("pb"))
        gone = cut(chain.join(above, ["tree", "parent"], "left").join(below, ["tree", "child"], "left")
                   .where("(pa IS NULL OR p > pa) AND (pb IS NULL OR p > pb)")
                   .select(*AT, "parent", "dist", "steps", "child", "child_dist", "child_steps"))
        out.append(Step(gone, True))
        longer = gone.select("tree", F.col("child").alias("node"), F.col("parent").alias("to"), F.col("dist").alias("d"), F.col("steps").alias("s"))
        left = table.join(gone.select(*AT), AT, "left_anti").join(longer, AT, "left")
        table = _with_children(left.select(*AT, F.coalesce("to", "parent").alias("parent"), (F.col("dist") + F.coalesce("d", F.lit(0.0))).alias("dist"),
                                           (F.col("steps") + F.coalesce("s", F.lit(0))).alias("steps")))


def _union(*parts: DataFrame | None) -> DataFrame | None:
    found = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def _of(rows: DataFrame | None, step: Step) -> DataFrame | None:
    return None if rows is None else rows.join(step.nodes.select(*AT), AT, "left_semi")


def _without(rows: DataFrame | None, step: Step) -> DataFrame | None:
    return None if rows is None else rows.join(step.nodes.select(*AT), AT, "left_anti")


def _moved(rows: DataFrame | None, step: Step, to: str, by: str | None = None, frm: str = "node") -> DataFrame | None:
    """Rows at one end (``frm``) of the step's edges, at the other end (``to``); ``d`` grows by ``by``."""
    if rows is None:
        return None
    ends = step.nodes.select("tree", F.col(frm).alias("node"), F.col(to).alias("__to"), *([F.col(by).alias("__by")] if by else []))
    got = rows.join(ends, AT).withColumn("node", F.col("__to"))
    if by:
        got = got.withColumn("d", F.col("d") + F.col("__by"))
    return got.select(*rows.columns)


def fold_up(edges: DataFrame, values: DataFrame, merge: dict[str, Callable[[str], Column]], keys: Sequence[str] = (), plan: list[Step] | None = None) -> DataFrame:
    """(tree, node, keys…, states…) for every node with a value in its subtree, the node included.

    ``values``: tree, node, ``keys`` and one column for each state, any number of rows a node;
    ``merge`` names the aggregate of each state, which must not depend on order or grouping
    (sum, min, max, bit_xor).  Values at nodes the trees do not have are ignored; a null tree or
    node is none.  Rows are at most nodes × keys below them.
    """
    plan = contract(edges) if plan is None else plan
    by = [*AT, *keys]

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by).agg(*[f(c).alias(c) for c, f in merge.items()])

    own = cut(merged(values.select(*by, *merge).join(edges.select(*AT), AT, "left_semi")))
    carry, done, shortened = None, [], []
    for step in plan:
        mine, between = _of(own, step), _of(carry, step)
        if not step.compress:
            done.append(mine)
            own = cut(merged(_union(_without(own, step), _moved(_union(mine, between), step, "parent"))))
            carry = _without(carry, step)
            continue
        # what hangs between the child and the node is below the node too
        hung = None if carry is None else _moved(carry, step, "node", frm="child")
        shortened.append((step, _union(mine, hung)))
        carry = cut(merged(_union(_without(carry, step), _moved(_union(mine, between), step, "child"))))
        own = _without(own, step)
    whole = _union(*done, own)
    whole = cut(whole) if shortened else whole
    for step, part in reversed(shortened):
        whole = _union(whole, cut(merged(_union(part, _moved(whole, step, "node", frm="child")))))
    return whole


def follow(rows: DataFrame, up: DataFrame) -> DataFrame:
    """Left outer join of ``rows`` (tree, node, ptr, …) with ``up`` (tree, ptr, …).  Rows without a pointer, most of them after
    the first rounds, are not shuffled, and those that point at one node, as at the root, are dealt over tasks."""
    moving = rows.where("tree IS NOT NULL AND ptr IS NOT NULL")
    met = moving.groupBy("tree", "ptr").agg(F.count("*").alias("rows"))
    # also what leads nowhere is met, so that its rows are dealt too
    met = cut(met.join(up, ["tree", "ptr"], "left"))
    went = join_unique(moving, met, ["tree", "ptr"], "rows", ["node"], small=16 << 20)
    return went.unionByName(rows.where("tree IS NULL OR ptr IS NULL"), allowMissingColumns=True)


def highest_above(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """(tree, node, top): largest ``score`` of ``scored`` (tree, node, score) on the path from the
    node, itself included, to the root; null where none has one.  Pointers double."""
    state = cut(edges.join(scored.select(*AT, F.col("score").alias("top")), AT, "left").select(*AT, F.col("parent").alias("ptr"), "top"))
    while not state.where("ptr IS NOT NULL").isEmpty():
        up = state.select("tree", F.col("node").alias("ptr"), F.col("ptr").alias("further"), F.col("top").alias("above"))
        state = cut(follow(state, up).select(*AT, F.col("further").alias("ptr"), F.greatest("top", "above").alias("top")))
    return state.drop("ptr")


def nearest(edges: DataFrame, refs: DataFrame, k: int, by: str = "dist", plan: list[Step] | None = None) -> DataFrame:
    """(tree, node, ref, d, lca): the k references (tree, node) nearest to every node, itself
    included where it is one, by summed length or (``by='steps'``) number of edges, ties by
    reference; ``lca`` is the highest node of the path.  Lengths must not be negative.

    Every node and every shortened edge keeps k rows.  Windows keep k rows of a node before the
    shuffle, so a node with most of the children does not gather them.
    """
    plan = contract(edges) if plan is None else plan
    order = Window.partitionBy(*AT).orderBy("d", "ref")

    def best(rows: DataFrame | None) -> DataFrame | None:
        return None if rows is None else rows.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= k).drop("__rn")

    zero = F.lit(0) if by == "steps" else F.lit(0.0)
    # below: from a node; up: what hangs on a shortened edge, from its upper end; down: the same, from its lower end
    own = cut(refs.select(*AT).join(edges.select(*AT), AT, "left_semi").distinct().select(*AT, F.col("node").alias("ref"), zero.alias("d")))
    up = down = None
    done, shortened, hanging = [], [], []
    for step in plan:
        mine = _of(own, step)
        hanging.append(_of(down, step))
        if not step.compress:
            done.append(mine)
            own = cut(best(_union(_without(own, step), _moved(mine, step, "parent", by), _moved(_of(up, step), step, "parent"))))
            up, down = _without(up, step), _without(down, step)
            continue
        inner = _moved(up, step, "node", frm="child")
        shortened.append((step, _union(mine, inner)))
        high = _union(_moved(_of(up, step), step, "child"), _moved(_lengthened(_union(mine, inner), step, by), step, "child"))
        kids = step.nodes.select("tree", F.col("child").alias("node"))
        rest = None if up is None else up.join(kids, AT, "left_anti")
        low = _moved(_union(mine.withColumn("lca", F.col("node")), _of(down, step)), step, "child", f"child_{by}")
        up = cut(best(_union(_without(rest, step), high)))
        down = cut(best(_union(_without(down, step), low)))
        own = _without(own, step)
    below = _union(*done, own)
    below = cut(below) if shortened else below
    for step, part in reversed(shortened):
        below = _union(below, cut(best(_union(part, _moved(below, step, "node", f"child_{by}", frm="child")))))
    below = cut(below.withColumn("lca", F.col("node")))
    roots = edges.where("parent IS NULL").select(*AT)
    whole = cut(below.join(roots, AT, "left_semi"))
    # a reference met twice is nearest by the way that does not go up and come back
    for step, edge in zip(reversed(plan), reversed(hanging)):
        ways = _union(_of(below, step).withColumn("way", F.lit(0)), None if edge is None else edge.withColumn("way", F.lit(1)),
                      _moved(whole, step, "node", by, frm="parent").withColumn("way", F.lit(2)))
        one = ways.groupBy(*AT, "ref").agg(F.min(F.struct("d", "way", "lca")).alias("m")).select(*AT, "ref", "m.d", "m.lca")
        whole = _union(whole, cut(best(one)))
    return whole


def _lengthened(rows: DataFrame, step: Step, by: str) -> DataFrame:
    """Rows at the step's nodes as seen from their parents."""
    lengths = step.nodes.select(*AT, F.col(by).alias("__by"))
    return rows.join(lengths, AT).withColumn("d", F.col("d") + F.col("__by")).select(*rows.columns)
