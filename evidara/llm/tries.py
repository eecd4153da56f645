"""Prefix trie of conversations.

Equal conversations collapse first.  The distinct ones are put in the order of their turns, block of turns by block of
turns, so that neighbours know their longest common prefix (LCP).  The trie then comes from union-find over these LCP
edges in descending depth: each merge of components creates a branching node.  Ranges of the order build their forests
on their own.  What an edge to the next range could still change (at most one node for each depth at either border) is
contracted and merged with the neighbours' in a tree of ranges.  Nodes between branching nodes are filled in
from the turns of the smallest member.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidara.joins import join_unique
from evidara.llm.common import stash
from evidara.ordering import Scan, running, with_range

#: turns that are compared at a time; longer common prefixes take further rounds
BLOCK = 256
#: neighbouring ranges whose open nodes are merged in one task
FAN = 16
_HEX = 32
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, digest, words): turns in order, null turns first, equal ones by the digest of role and text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn"), F.lit(0)).alias("place"),
        F.substring(F.sha2(content.cast("binary"), 256), 1, _HEX).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    rows = stash(rows.withColumn("copy", F.monotonically_increasing_id()))
    got = running(rows, ["conv"], ["known", "place", "digest", "copy"], {"pos": Scan("sum", F.lit(1), "upto")}, cut_input=False)
    return got.select("conv", F.col("pos").cast("long").alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, every: int = 20, kinds: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv, d, digest, words) and (conv): conversations whose first h turns are those of the conversation
    ``conv - conv % every``, h = crc32(conv) % ``kinds``."""
    turns = stash(turns)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % kinds).cast("int")
    convs = turns.groupBy("conv").agg(F.count("*").alias("rows")).withColumn("h", h)
    convs = convs.withColumn("donor", F.col("conv") - F.col("conv") % every)
    heads = turns.where(F.col("pos") < kinds).select(F.col("conv").alias("donor"), F.col("pos").alias("d"), "digest", "words")
    lead = stash(convs.join(heads, "donor").where(F.col("d") <= F.col("h")).select("conv", "d", "digest", "words"))
    got = lead.groupBy("conv").agg(F.count("*").alias("got"))
    short = convs.join(got, "conv", "left").withColumn("shift", F.col("h") - F.coalesce("got", F.lit(0)))
    short = stash(short.where("shift > 0").select("conv", "rows", "shift"))
    own = join_unique(turns.where(F.col("pos") > h), short, ["conv"], "rows", ["conv", "pos"])
    own = own.select("conv", (F.col("pos") - F.coalesce("shift", F.lit(0))).alias("d"), "digest", "words")
    return lead.select(*own.columns).union(own), convs.select("conv")


def _equal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows (code, conv) in order: smallest conv, number of rows, digest of all their numbers."""
    code, head, count, digest = None, None, 0, None
    for batch in batches:
        out = []
        codes, convs = batch["code"].to_numpy(), batch["conv"].to_numpy()
        begin = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else []
        for a, b in zip(begin, [*begin[1:], len(codes)]):
            if codes[a] != code:
                if code is not None:
                    out.append((head, count, digest.hexdigest()))
                code, head, count, digest = codes[a], convs[a], 0, hashlib.sha256()
            text = ",".join(map(str, convs[a:b].tolist()))
            digest.update(("," + text if count else text).encode())
            count += int(b - a)
        yield pd.DataFrame(out, columns=["conv", "n", "ends"])
    if code is not None:
        yield pd.DataFrame([(head, count, digest.hexdigest())], columns=["conv", "n", "ends"])


def distinct_conversations(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, n, ends, len, w): one row for each distinct sequence of turns, named by its smallest conversation, with the
    number of conversations, the digest of their numbers in order, its turns and words."""
    part = [F.sum(F.xxhash64(*c).cast("decimal(38,0)")) for c in (("digest", "d"), ("d", F.lit("second"), "digest"))]
    sums = turns.groupBy("conv").agg(F.count("*").alias("len"), F.sum("words").alias("w"), F.concat_ws(" ", *part).alias("code"))
    full = stash(convs.join(sums, "conv", "left").select(
        "conv", F.coalesce("len", F.lit(0)).alias("len"), F.coalesce("w", F.lit(0)).alias("w"), F.coalesce("code", F.lit("")).alias("code")))
    # the digest of a group reads its numbers in order: they stream through a task, none holds them
    ordered = full.withColumn("code", F.concat_ws(" ", "len", "code")).select("code", "conv").repartition("code").sortWithinPartitions("code", "conv")
    return ordered.mapInPandas(_equal, "conv long, n long, ends string").join(full.drop("code"), "conv")


@F.pandas_udf(T.IntegerType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([-1 if y is None else len(os.path.commonprefix((x, y))) // _HEX for x, y in zip(a, b)], dtype="int32")


def in_order(turns: DataFrame, seqs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``seqs`` (conv, len, ...) with ``path``, an array that orders them by their turns, and the depth ``lcp`` and words
    ``wlcp`` of the prefix each shares with the one before (-1 and 0 for the first).

    A round compares one block of ``block`` turns; sequences that agree with a neighbour in a whole block go
    on, so rounds grow with the longest prefix that two different conversations share.
    """
    state = seqs.select("conv", "len", F.lit(0).cast("long").alias("g"), F.lit(-1).cast("long").alias("lcp"), F.lit(0).cast("long").alias("wlcp"),
                        F.array().cast("array<long>").alias("path"), F.lit(0).cast("long").alias("before"))
    blocks = turns.withColumn("block", F.floor((F.col("d") - 1) / block))
    out, r = None, 0
    while True:
        piece = blocks.where(F.col("block") == r).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("d", "digest", "w"))).alias("t"))
        cur = state.join(piece, "conv", "left").select(
            *state.columns, F.coalesce(F.array_join(F.transform("t", lambda x: x["digest"]), ""), F.lit("")).alias("turns"),
            F.concat(F.array("before"), F.coalesce(F.col("t.w"), F.array().cast("array<long>"))).alias("cum"))
        cur = stash(running(stash(cur), [], ["g", "turns", "conv"], {
            "prev": Scan("max", F.struct("g", "turns")), "row": Scan("sum", F.lit(1).cast("long"), "upto")}, cut_input=False))
        kin = F.coalesce(F.col("prev.g") == F.col("g"), F.lit(False))
        cur = cur.withColumn("common", F.when(kin, _common("turns", "prev.turns"))).withColumn("same", kin & (F.col("prev.turns") == F.col("turns")))
        new = F.col("common").isNotNull() & ~F.col("same")
        cur = stash(cur.select(
            "conv", "len", "row", "same", "path", F.when(new, F.col("common") + r * block).otherwise(F.col("lcp")).alias("lcp"),
            F.when(new, F.get("cum", F.col("common"))).otherwise(F.col("wlcp")).alias("wlcp"),
            F.element_at("cum", -1).alias("before"), (F.length("turns") == _HEX * block).alias("full")))
        if cur.where("full and same").isEmpty():
            done = cur.select("conv", F.concat("path", F.array("row")).alias("path"), "lcp", "wlcp")
            return seqs.join(done if out is None else out.union(done), "conv")
        # a run of equal blocks is named by its first row, whose prefix is that of the run's first in the end; the other runs are done
        named = running(cur, [], ["row"], {
            "head": Scan("max", F.when(~F.col("same"), F.struct("row", "lcp", "wlcp")), "upto")}, cut_input=False)
        after = cur.where("same").select((F.col("row") - 1).alias("row"), F.lit(True).alias("followed"))
        named = stash(named.join(after, "row", "left").select(
            "conv", "len", F.col("head.row").alias("g"), F.col("head.lcp").alias("lcp"), F.col("head.wlcp").alias("wlcp"),
            F.concat("path", F.array("head.row")).alias("path"), "before",
            (F.col("full") & (F.col("same") | F.coalesce("followed", F.lit(False)))).alias("on")))
        done = named.where("not on").select("conv", "path", "lcp", "wlcp")
        out = done if out is None else out.union(done)
        state = named.where("on").drop("on")
        r += 1


class Node:
    """A component: a node of the trie with the sums of what is known below it.  ``kids`` are closed children."""

    __slots__ = ("depth", "ender", "id", "kids", "leaves", "low", "n", "saved", "w")

    def __init__(self, depth: int, w: int, n: int, low: int | None, leaves: int, saved: int, kids: int, id: str, ender: int | None) -> None:
        self.depth, self.w, self.n, self.low, self.leaves = depth, w, n, low, leaves
        self.saved, self.kids, self.id, self.ender = saved, kids, id, ender

    def row(self) -> tuple:
        return self.depth, self.w, self.n, self.low, self.leaves, self.saved, self.kids, self.id, self.ender

    def take(self, other: Node) -> None:
        """Sums of another part of the same node."""
        self.n += other.n
        self.leaves += other.leaves
        self.saved += other.saved
        self.kids += other.kids
        if other.low is not None:
            self.low = other.low if self.low is None else min(self.low, other.low)
        if self.ender is None:
            self.ender = other.ender


class Forest:
    """Components in order with the edges between them; an edge is the still childless part of the node at its depth."""

    def __init__(self, nodes: list[Node], edges: list[Node]) -> None:
        self.nodes, self.edges = nodes, edges
        self.closed: list[tuple[Node, str, int, int]] = []
        self.alias: dict[str, str] = {}

    def _child(self, child: Node, parent: Node) -> None:
        self.closed.append((child, parent.id, parent.depth, parent.w))
        leaves = child.leaves if child.kids else 1
        saved = (child.n - 1) * (child.w - parent.w) + child.saved
        parent.take(Node(0, 0, child.n, child.low, leaves, saved, 1, "", None))

    def _merge(self, a: Node, edge: Node, b: Node) -> Node:
        """The node at the depth of ``edge``; ``a`` and ``b`` are that node already, or become its children."""
        top = a if a.depth == edge.depth else edge
        for part in (a, edge, b):
            if part is top:
                continue
            if part.depth == top.depth:
                top.take(part)
                self.alias[part.id] = top.id
            else:
                self._child(part, top)
        return top

    def contract(self, left: int, right: int) -> None:
        """Union-find over the edges in descending depth, but for edges whose component could grow over a border:
        ``left`` and ``right`` are the depths of the edges there.  Of those, neighbours of one depth become one."""
        depth = np.array([e.depth for e in self.edges], np.int64)
        first, last = np.minimum.accumulate(depth), np.minimum.accumulate(depth[::-1])[::-1]
        waiting = ((depth == first) & (depth <= left)) | ((depth == last) & (depth <= right))
        up = list(range(len(self.nodes)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for k in sorted(np.flatnonzero(~waiting).tolist(), key=lambda k: -depth[k]):
            a, b = find(k), find(k + 1)
            self.nodes[a] = self._merge(self.nodes[a], self.edges[k], self.nodes[b])
            up[b] = a
        nodes, edges = [self.nodes[find(0)]], []
        for k in np.flatnonzero(waiting).tolist():
            edge = self.edges[k]
            if edges and edges[-1].depth == edge.depth:
                self._child(nodes.pop(), edges[-1])
                edges[-1].take(edge)
                self.alias[edge.id] = edges[-1].id
            else:
                edges.append(edge)
            nodes.append(self.nodes[find(k + 1)])
        self.nodes, self.edges = nodes, edges

    def name(self, id: str) -> str:
        while id in self.alias:
            id = self.alias[id]
        return id


_PART = "depth long, w long, n long, low long, leaves long, saved long, kids long, id string, ender long"
_STATE = f"kind int, part long, at long, {_PART}, " + ", ".join(f"e_{c.strip()}" for c in _PART.split(",")) + ", parent string, top long, w_top long"
_COLUMNS = [c.split()[0] for c in _STATE.split(",")]
_NODE, _OPEN, _ALIAS = 0, 1, 2


def _number(x) -> int | None:
    return None if x is None or x is pd.NA or x != x else int(x)


def _forests(last: bool):
    """Merge the components of neighbouring parts; ``last`` closes the root."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(order=[tuple(p) for p in rows["path"]]).sort_values(["part", "order"]) if "path" in rows else rows.sort_values(["part", "at"])
        made = {p: [Node(*[_number(v) if c != "id" else v for c, v in zip(_COLUMNS[3:12], r)])
                    for r in rows[[p + c for c in _COLUMNS[3:12]]].itertuples(index=False, name=None)] for p in ("", "e_")}
        border, edges = made["e_"][0], made["e_"][1:]
        forest = Forest(made[""], edges)
        forest.contract(border.depth, int(rows["right"].iloc[-1]))
        nodes = forest.nodes
        if last:
            root = nodes[0]
            if root.depth > 0:
                root = Node(0, 0, 0, None, 0, 0, 0, "root", None)
                forest._child(nodes[0], root)
            forest.closed.append((root, None, -1, 0))
            nodes = []
        none = (None,) * 9
        out = [(_NODE, None, None, *c.row(), *none, parent and forest.name(parent), top, w) for c, parent, top, w in forest.closed]
        out += [(_OPEN, int(key[0]), i, *c.row(), *e.row(), None, None, None) for i, (c, e) in enumerate(zip(nodes, [border, *forest.edges]))]
        if "path" not in rows:
            out += [(_ALIAS, None, None, *none[:7], old, None, *none, forest.name(new), None, None) for old, new in forest.alias.items()]
        got = pd.DataFrame(out, columns=_COLUMNS)
        return got.astype({c: "Int64" for c in _COLUMNS if c not in ("id", "e_id", "parent", "kind")})
    return run


def _right(open_: DataFrame, order: str) -> DataFrame:
    """Parts with the depth of the edge behind their last component."""
    first = open_.groupBy("part").agg(F.min_by("e_depth", order).alias("depth"))
    after = F.lead("depth", 1, -1).over(Window.partitionBy(F.lit(0)).orderBy("part"))
    return F.broadcast(first.select("part", after.alias("right")))


def branching_nodes(ordered: DataFrame, ranges: int | None = None, fan: int = FAN) -> DataFrame:
    """(id, depth, w, n, low, leaves, saved, kids, ender, parent, top, w_top): nodes of the trie that branch or where a
    sequence (``ender``) ends, from sequences (conv, n, len, w, path, lcp, wlcp).

    ``n`` members, the smallest ``low``; ``leaves`` below; ``kids`` children; ``saved`` over the subtree without the
    chain up to the ``parent``, which ends below depth ``top`` and has ``w_top`` words up to there.  The root has no parent.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    own = {"depth": F.col("len"), "w": F.col("w"), "n": F.col("n"), "low": F.col("conv"), "leaves": zero, "saved": zero, "kids": zero,
           "id": F.concat(F.lit("s"), F.col("conv")), "ender": F.col("conv")}
    edge = {"depth": F.col("lcp"), "w": F.col("wlcp"), "n": zero, "low": none, "leaves": zero, "saved": zero, "kids": zero,
            "id": F.concat(F.lit("e"), F.col("conv")), "ender": none}
    keyed = with_range(stash(ordered), ["path"], ranges, "part")
    open_ = stash(keyed.select(F.col("part").cast("long").alias("part"), "path", *[c.alias(k) for k, c in own.items()],
                               *[c.alias("e_" + k) for k, c in edge.items()]))
    parts = open_.agg(F.max("part")).first()[0]
    parts = 0 if parts is None else parts + 1
    nodes, aliases, by, order = [], [], 1, "path"
    while parts:
        rows = open_.join(_right(open_, order), "part").withColumn("group", F.floor(F.col("part") / by).cast("long"))
        parts = -(-parts // by)
        state = stash(rows.groupBy("group").applyInPandas(_forests(parts == 1), _STATE))
        nodes.append(state.where(F.col("kind") == _NODE).drop("kind", "part", "at", *[c for c in _COLUMNS if c.startswith("e_")]))
        if by > 1:
            aliases.append(state.where(F.col("kind") == _ALIAS).select(F.col("id").alias("parent"), F.col("parent").alias("to")))
        open_, by, order = state.where(F.col("kind") == _OPEN).drop("kind", "parent", "top", "w_top"), fan, "at"
        if parts == 1:
            break
    if not nodes:
        return ordered.sparkSession.createDataFrame([], f"{_PART}, parent string, top long, w_top long")
    # a parent that was merged with its part in another range later has that part's name
    out = nodes[0]
    for more, alias in zip([*nodes[1:]], aliases):
        out = out.join(alias, "parent", "left").withColumn("parent", F.coalesce("to", "parent")).drop("to").unionByName(more)
    return out


def _chains(turns: DataFrame, nodes: DataFrame) -> DataFrame:
    """A row for each turn that makes a node: ``mark`` is the first branching node at or below it on the way to its smallest member."""
    fields = ["depth", "w", "n", "leaves", "saved", "kids", "top", "parent_low", "ends"]
    marks = nodes.where("depth > 0").select(F.col("low").alias("conv"), F.col("depth").alias("d"), F.struct(*fields).alias("mark"))
    rows = stash(turns.select("conv", "d", "w", "words").join(marks, ["conv", "d"], "left"))
    return running(rows, ["conv"], ["d"], {"next": Scan("min", F.col("mark"), "from")}, cut_input=False).where(F.col("d") > F.col("next.top"))


def prefix_trie(conversations: DataFrame, block: int = BLOCK, ranges: int | None = None, fan: int = FAN, every: int = 20, kinds: int = 4) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per trie node, from
    turns (conv_id, turn, role, text).

    Turns are ordered by turn, null first, equal ones by the SHA-256 of role and text.  Null role and text are
    empty.  Conversation c is rebuilt from the first h = crc32(c) % ``kinds`` turns of conversation c - c % ``every``
    (as many as it has) and its own turns after its first h.  Each distinct sequence of first d turns is a node; the
    root has depth 0.  A node is named by its smallest member and its depth.  ``n_leaves`` and ``saved_tokens``
    (members beyond the first times words of the last turn) count the subtree with its top; ``ends_sha256`` is the digest of the
    numbers, in order and joined by commas, of the conversations that end at the node.

    Rows without conv_id are left out; repeated rows are turns of their own.  Turns are compared by 128 bits of the
    SHA-256 of role and text, equal conversations by two 64-bit sums over their turns.  Further columns are
    ignored; an empty table gives no rows.
    """
    turns, convs = rebuilt(numbered_turns(conversations), every, kinds)
    turns = stash(running(stash(turns), ["conv"], ["d"], {"w": Scan("sum", F.col("words"), "upto")}, cut_input=False))
    seqs = stash(distinct_conversations(turns, convs))
    firsts = turns.join(seqs.select("conv"), "conv", "left_semi")
    nodes = stash(branching_nodes(in_order(firsts, seqs, block), ranges, fan))
    nodes = nodes.withColumn("leaves", F.when(F.col("kids") > 0, F.col("leaves")).otherwise(F.lit(1)))
    above = nodes.where("kids > 0").select(F.col("id").alias("parent"), F.col("low").alias("parent_low"), "kids").withColumnRenamed("kids", "rows")
    nodes = join_unique(nodes, above, ["parent"], "rows", ["id"])
    nodes = stash(nodes.join(seqs.select(F.col("conv").alias("ender"), "ends"), "ender", "left"))

    def ends(at_end: Column, value: Column) -> Column:
        return F.coalesce(F.when(at_end, value), F.lit(NO_ENDS)).alias("ends_sha256")

    root = nodes.where("depth = 0").select(
        F.col("low").alias("conv_id"), F.col("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), ends(F.lit(True), F.col("ends")))
    got = _chains(firsts, nodes)
    mark, bottom = F.col("next"), F.col("d") == F.col("next.depth")
    saved = (mark["n"] - 1) * (mark["w"] - F.col("w") + F.col("words")) + mark["saved"]
    parent = F.when(F.col("d") - 1 > mark["top"], F.col("conv")).otherwise(mark["parent_low"])
    return root.union(got.select(
        "conv", "d", parent, mark["n"], F.when(bottom, mark["kids"]).otherwise(F.lit(1)), mark["leaves"], saved, ends(bottom, mark["ends"])))
