"""Exact duplicates by chunk recipes against plain comparison."""

import random
from collections import defaultdict

import pytest
from helpers import LONG, docs, same, sha
from pyspark.sql import functions as F

from evidara.llm import recipes
from evidara.llm.recipes import chunks, drop_copies, exact_groups, folded

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(LOWER)].append(d)
    out = []
    for d, t in rows:
        t = (t or "").translate(LOWER)
        ids = [x for x in groups[t] if x is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, len(groups[t]), d == keep, sha(t.encode())))
    return out


def texts(n, seed):
    r = random.Random(seed)
    letters = "abcdeINRSTxyzÄäÖÉéΣσςİıßǅⅨⓐ日本 \n\t.,-"
    base = ["".join(r.choice(letters) for _ in range(r.randrange(0, 40))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        t = r.choice(base) * r.choice([1, 1, 2, 30])
        out.append((i, t.upper() if r.random() < 0.1 else t.swapcase() if r.random() < 0.1 else t))
    return out


EDGES = [(-1, None), (-2, ""), (-3, " "), (None, "x"), (None, "x"), (900, "x"), (900, "X"), (901, LONG), (902, LONG.upper()), (903, LONG + "."), (None, "alone")]


def test_folding_touches_nothing_but_a_to_z(spark):
    every = "".join(chr(c) for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000)
    parts = [every[i : i + 64] for i in range(0, len(every), 64)] + ["ΑΣ ΑΣ.", "İI", "AΣ", "plain ASCII Text"]
    df = spark.createDataFrame([(p,) for p in parts], "t string")
    assert [tuple(r) for r in df.select("t", folded(F.col("t"))).collect()] == [(p, p.translate(LOWER)) for p in parts]


@pytest.mark.parametrize("least, most", [(256, 2048), (4, 10), (1, 7)])
def test_chunks_are_the_text(spark, least, most):
    rows = [(t or "",) for _, t in texts(60, 1) + EDGES]
    got = spark.createDataFrame(rows, "t string").select("t", chunks(F.col("t"), least, most)).collect()
    assert all("".join(c) == t and all(len(x) <= most for x in c) for t, c in got)


def test_an_insertion_changes_the_chunks_around_it(spark):
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdefghinrst") for _ in range(r.randrange(2, 9))) for _ in range(20_000))
    a, b = (set(x[0]) for x in spark.createDataFrame([(text,), (text[:50_000] + " new words " + text[50_000:],)], "t string").select(chunks(F.col("t"))).collect())
    assert len(a) > 100 and len(a - b) <= 4 and len(b - a) <= 4


@pytest.mark.parametrize("least, most", [(256, 2048), (4, 10)])
def test_groups_match_plain_comparison(spark, least, most):
    rows = texts(200, 2) + EDGES
    assert same(exact_groups(docs(spark, rows), least, most).collect(), plain(rows))


def test_identifiers_that_contents_share_are_given_up(spark):
    """With the length as digest nearly all chunks collide; the next digest is taken, and last the chunk itself."""
    rows = texts(120, 4) + EDGES
    weak = (lambda c: F.length(c).cast("long"), lambda c: F.substring(c, 1, 1))
    pieces = docs(spark, rows).select(F.explode(chunks(F.coalesce("text", F.lit("")), 4, 10)).alias("chunk"))
    assert recipes.verified(pieces, (*weak, recipes.DIGESTS[1], recipes.DIGESTS[2])) is recipes.DIGESTS[1]
    assert recipes.verified(pieces, (*weak, recipes.DIGESTS[2])) is recipes.DIGESTS[2]
    assert same(exact_groups(docs(spark, rows), 4, 10, (*weak, recipes.DIGESTS[2])).collect(), plain(rows))


def test_a_hot_group_is_dealt_over_tasks(spark):
    rows = [(i, "the same" if i % 3 else f"text {i // 6}") for i in range(600)]
    got = exact_groups(docs(spark, rows), small=0, hot=20)
    assert same(got.collect(), plain(rows))


def test_empty_table_and_clashing_names(spark):
    assert exact_groups(docs(spark, [])).collect() == []
    clash = docs(spark, [(1, "a"), (2, "A")]).withColumn("recipe", F.lit(1)).withColumn("chunks", F.lit(2)).withColumn("code", F.lit(3))
    assert same([r[:4] for r in exact_groups(clash).collect()], [(1, 2, 2, False), (2, 2, 2, True)])


def test_drop_copies_keeps_columns(spark):
    rows = texts(80, 5) + EDGES
    kept = drop_copies(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    assert same(kept.select("doc_id", "text").collect(), [row for row, p in zip(rows, plain(rows)) if p[3]])
