"""Lexical search against a complete scan in Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, docs, same

from evidara.llm import lexical
from evidara.llm.lexical import rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, k):
    held = [(d, Counter(split(t))) for d, t in rows]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 75 + 25 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


def corpus(n, seed, vocabulary=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ärger", "ärger", "日本", "É", "x_y", "A.B"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(r.choices(words, weights, k=r.choice([0, 1, 3, 10, 80])))) for i in range(n)]


def bench(spark, items):
    rows = [(i, t, 1, 2, 3.0) for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, rank int, score double")


EDGES = [(-1, None), (-2, ""), (-3, " .,;"), (None, "w1 w2"), (None, "w1 w2"), (7, "W1, w2"), (7, "w1 w2 w3"), (8, LONG), (9, "w59 " * 500)]


@pytest.mark.parametrize("k, first", [(5, 4096), (3, 1), (400, 10)])
def test_matches_a_complete_scan(spark, k, first):
    rows = corpus(200, 1) + EDGES
    items = corpus(12, 2) + [(3, "w1 w1 w1 W2"), (None, "w5 w6"), (50, None), (51, "unknown words"), (52, "w1x0"), (None, "w5 w6")]
    assert same(rank_documents(docs(spark, rows), bench(spark, items), k, first).collect(), plain(rows, items, k))


def test_items_in_blocks_and_equal_scores(spark):
    rows = [(i, "w1 w2") for i in range(300, 0, -1)] + corpus(50, 3)
    items = corpus(10, 4)
    assert same(rank_documents(docs(spark, rows), bench(spark, items), 20, 8, block_terms=5).collect(), plain(rows, items, 20))


def test_empty_tables(spark):
    some, none = corpus(5, 1), []
    for rows, items in ((some, none), (none, some), (none, none), ([(1, None)], some), (some, [(1, " ")])):
        got = rank_documents(docs(spark, rows), bench(spark, items))
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []


def test_long_texts_are_cut_outside_terms():
    texts = [None, "", "a" * 50, "ab cd " * 20 + "e" * 40 + " fg", "日本語 " * 9, "." * 30]
    batch = pa.record_batch({"doc_id": pa.array(range(6)), "text": pa.array([t and t.encode() for t in texts], pa.binary())})
    got = Counter()
    for rows, parts in lexical._slices(batch, 7):
        for r, p in zip(rows, parts):
            got.update((r, t) for t in split(p.decode()))
    assert got == Counter((r, t) for r, x in enumerate(texts) for t in split(x))


def test_bounds_prune_and_lose_nothing():
    """Buckets in descending length: the lengths and the heavy coordinates leave few vectors to score in full."""
    rng = np.random.default_rng(0)
    vocabulary, n = 300, 4000
    vectors = [np.sort(rng.choice(vocabulary, rng.integers(1, 12), replace=False)) for _ in range(n)]
    impacts = [rng.integers(1, 10**6, len(v)) for v in vectors]
    length = np.array([math.sqrt((i.astype(float) ** 2).sum()) for i in impacts])
    order = np.argsort(-length, kind="stable")
    items = [lexical.Item(t, rng.integers(1, 9000, len(t)) ** 2 // 1000) for t in (rng.choice(vocabulary, 6, replace=False) for _ in range(30))]
    best = [lexical.Best(5, 1) for _ in items]
    looked = scored = 0
    for at in np.array_split(order, 16):
        row = np.repeat(np.arange(len(at)), [len(vectors[i]) for i in at])
        got = lexical.search_bucket(items, best, length[at], row, np.concatenate([vectors[i] for i in at]), np.concatenate([impacts[i] for i in at]),
                                    at.astype(np.int64), np.zeros(len(at), bool), vocabulary)
        looked, scored = looked + got[0], scored + got[1]
    for item, top in zip(items, best):
        weight = dict(zip(item.terms.tolist(), item.weights.tolist()))
        every = sorted(((-sum(weight.get(t, 0) * i for t, i in zip(v.tolist(), x.tolist())), d) for d, (v, x) in enumerate(zip(vectors, impacts))))
        assert [(-s, d) for s, d in every[:5] if s < 0] == list(zip(top.score.tolist(), top.id.tolist()))
    assert scored < looked < 0.9 * n * len(items) and scored < 0.1 * n * len(items)
