"""Brute-force counterparts and edge tables for the pipeline operators."""

import hashlib
import random
from collections import Counter

LONG = " ".join(f"w{i % 5000}x{i // 5000}" for i in range(30_000))
DOC = "doc_id long, text string, lang string, source string, key long, kept int, n long, owner string, tokens int, weight double, topic string, host string"


def docs(spark, rows):
    """Documents (doc_id, text[, lang, source]) with extra columns whose names the operators use themselves."""
    full = [(*r, *("en", "s0")[len(r) - 2 :], 7, 1, 3, "o", 5, 0.5, "x", "h") for r in rows]
    return spark.createDataFrame(full, DOC)


def words_text(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"v{r.randrange(vocabulary)}" for _ in range(n))


def same(got, want):
    return Counter(map(tuple, got)) == Counter(map(tuple, want))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def near_duplicates(rows, k, percent):
    """component of each row: (doc_id, text) -> (doc_id, n, component, kept)"""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] and sets[i] and sets[j] or both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        if d is None:
            out.append((None, len(sets[i]), None, True))
        else:
            c = min(rows[j][0] for j in range(len(rows)) if rows[j][0] is not None and find(j) == find(i)) if sets[i] else d
            out.append((d, len(sets[i]), c, c == d))
    return out


def word_removal(rows, length):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - length + 1):
            g = tuple(w[i : i + length])
            if d is not None and (g not in first or d < first[g]):
                first[g] = d
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i : i + length])] < d:
                gone.update(range(i, i + length))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), sha(b" ".join(kept))))
    return out


def byte_removal(rows, length):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out
