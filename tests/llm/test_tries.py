"""The conversation trie against a trie built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import LONG, same

from evidara.llm.tries import Forest, Node, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos int, d long, digest string, part int"


def plain(rows, every=20, kinds=4):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append((t is not None, t or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in turns.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % kinds
        donor = c - (c % every if c >= 0 else -(-c % every))
        made[c] = tuple(own.get(donor, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len([w for w in p[-1][1].encode().split()]) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
        ends = ",".join(str(c) for c in sorted(members[p]) if len(made[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talks(n, seed, most=9, words=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-50, 400), n):
        for t in range(r.choice([1, 1, 2, 3, most])):
            rows.append((c, r.choice([t, t, t, 1, None]), r.choice(["user", "user", "user", None]), r.choice([" ".join(["a"] * r.randrange(words)), None, "b c"])))
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("options", [{}, {"block": 1, "ranges": 7, "fan": 2}, {"block": 2, "ranges": 40, "fan": 3}])
def test_matches_a_plain_trie(spark, options):
    rows = talks(120, 1) + [(None, 0, "user", "lost"), (1000, 0, "", LONG), (1001, 0, None, LONG), (1002, 5, "a", "bc"), (1003, 5, "ab", "c")]
    assert same(prefix_trie(frame(spark, rows), **options).collect(), plain(rows))


def test_deep_shared_prefixes_and_a_hot_conversation(spark):
    """Nested prefixes (each conversation ends inside the next), one conversation in a third of all, one long one."""
    rows = [(20 * c, t, "user", f"turn {t}") for c in range(1, 30) for t in range(c)]
    rows += [(20 * c, t, "user", f"hot {t}") for c in range(100, 160) for t in range(4)]
    rows += [(20 * 500, t, "user", f"turn {t}") for t in range(300)]
    want = plain(rows)
    for options in ({}, {"block": 3, "ranges": 16, "fan": 2}):
        assert same(prefix_trie(frame(spark, rows), **options).collect(), want)


def test_empty_turnless_and_single(spark):
    assert prefix_trie(frame(spark, [])).collect() == []
    # 1 takes turns of 0, which is not there
    rows = [(c, 0, "user", "one") for c in (1, 2, 3, 4)]
    assert same(prefix_trie(frame(spark, rows)).collect(), plain(rows))
    assert same(prefix_trie(frame(spark, [(20, 0, "a", "b")])).collect(), plain([(20, 0, "a", "b")]))


def test_forests_of_parts_equal_the_forest_of_the_whole():
    """Contracting ranges and merging what is left gives the nodes of one pass, on random sequences."""
    def leaf(i, s):
        return Node(len(s), len(s), 1, i, 0, 0, 0, f"s{i}", i)

    def found(closed, name):
        kept = {name(c.id): c for c, *_ in closed}
        return {(c.low, c.depth): (c.n, c.kids, c.leaves, c.saved, parent and (kept[parent].low, kept[parent].depth) if parent else None)
                for c, parent in ((c, p and name(p)) for c, p, *_ in closed)}

    for seed in range(60):
        r = random.Random(seed)
        seqs = sorted({tuple(r.randrange(2) for _ in range(r.randrange(0, 7))) for _ in range(r.randrange(2, 40))})
        lcp = [-1] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(seqs, seqs[1:])]

        def edges():
            return [Node(d, max(d, 0), 0, None, 0, 0, 0, f"e{i}", None) for i, d in enumerate(lcp)]

        whole = Forest([leaf(i, s) for i, s in enumerate(seqs)], edges()[1:])
        whole.contract(-1, -1)
        whole.closed.append((whole.nodes[0], None, -1, 0))
        cuts = sorted(r.sample(range(1, len(seqs)), min(len(seqs) - 1, 4)))
        closed, alias, nodes, left = [], {}, [], []
        for a, b in zip([0, *cuts], [*cuts, len(seqs)]):
            e = edges()
            part = Forest([leaf(i, s) for i, s in list(enumerate(seqs))[a:b]], e[a + 1 : b])
            part.contract(lcp[a], lcp[b] if b < len(seqs) else -1)
            closed += part.closed
            alias |= part.alias
            nodes += part.nodes
            left += ([e[a]] if a else []) + part.edges
        rest = Forest(nodes, left)
        rest.contract(-1, -1)
        rest.alias |= {k: v for k, v in alias.items() if k not in rest.alias}
        rest.closed = closed + rest.closed + [(rest.nodes[0], None, -1, 0)]
        assert found(rest.closed, rest.name) == found(whole.closed, whole.name)
