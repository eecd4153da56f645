"""URL filter, nearest neighbours, WARC archives."""

import base64
import gzip
import hashlib
import os
import random

import numpy as np
import pytest

import helpers as h
from evidara.llm import neighbours, urls, warc
from evidara.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, path string, rule string, verdict string, address string, n long, digest string, head long"


def pages(spark, rows):
    """Pages (page_id, url, html) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "h", "p", "r", "v", "a", 3, "d", 9) for r in rows], PAGES)


def canonical(to):
    return f'<html><head><LINK href="{to}" rel="x"><link rel="canonical" href="{to}"/></head>'


def refresh(to):
    return f"<meta http-equiv='refresh' content='0; URL={to}'>"


def test_url_rules(spark):
    cases = {
        "http://a.example.com/en/x": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://WWW.Example.com/en/1?q#f": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://x.www.example.com/en/": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://b.net/es/1": ("b.net", "/es/1", "net/es/", "block"),
        "http://b.net/esx": ("b.net", "/esx", None, "allow"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "http://c.org?x=/en/": ("c.org", "", None, "allow"),
        "http://a.b://c/d": ("a.b:", "//c/d", None, "allow"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "://": ("", "", None, "allow"),
        "http://" + "s." * 300 + "net/fr/" + "p" * 5000: ("s." * 300 + "net", "/fr/" + "p" * 5000, "net/fr/", "block"),
    }
    rows = [(i, u, None if i % 2 else "<p>") for i, u in enumerate(cases)] * 2
    got = urls.filter_urls(pages(spark, rows), URL_RULES).collect()
    assert h.same(got, [(i, *cases[u]) for i, u, _ in rows])


def test_aliases_carry_blocks_unless_allowed(spark):
    rows = [
        (1, "http://bad.net/es/1", "x"), (2, "http://a.org/1", canonical("http://bad.net/es/1")), (3, "http://b.org/2", refresh("http://a.org/1#top")),
        (4, "https://a.org/1", "the same address by another scheme"), (5, "http://c.org/3", canonical("/4")), (6, "http://c.org/4", refresh("//d.org")),
        (7, "http://d.org/", canonical("http://unseen.net/fr/9")), (8, "http://e.org/", canonical("http://bad.net/es/1?x")),
        (9, "http://f.org/1", canonical("http://bad.net/es/8")), (10, "http://f.org/1", refresh("http://fine.com/a")), (11, "http://bad.net/es/8", None),
        (12, "http://g.org/1", canonical("http://g.org/1")), (13, None, canonical("http://bad.net/es/1")), (14, "http://a.org/1?y", "another address"),
    ]
    got = {r.page_id: r.verdict for r in urls.filter_urls(pages(spark, rows), URL_RULES).collect()}
    blocked = {1, 2, 3, 4, 5, 6, 7, 8, 11}
    assert {i for i, v in got.items() if v == "block"} == blocked and len(got) == len(rows)


@pytest.mark.parametrize("url, html, target", [
    ("http://a.x/d/e.html?q=1", "<meta http-equiv=refresh content='0;url=next.html'>", "a.x/d/next.html"),
    ("http://a.x/d/e.html", "<link rel=canonical href='a/b'>", "a.x/d/a/b"),
    ("http://a.x/d/e/f", "<link rel=canonical href='../x'>", "a.x/d/x"),
    ("http://a.x/d", "<link rel=canonical href='../../x/./y/..'>", "a.x/x/"),
    ("http://a.x/d/e?p=1", "<link rel=canonical href='?p=2#z'>", "a.x/d/e?p=2"),
    ("http://a.x", "<link rel=canonical href='b?u=http://c.x/'>", "a.x/b?u=http://c.x/"),
    ("http://a.x/1", "<link rel=canonical href='/1'><LINK href='/2' rel=canonical>", "a.x/2"),
    ("http://a.x/1", "<meta http-equiv=refresh content='5'><meta http-equiv=refresh content='0;url=/2'>", "a.x/2"),
    ("http://a.x/1", "<meta content='0;url=/2' http-equiv=refresh>", "a.x/2"),
    ("http://a.x/1", "<link rel=canonical href='/2?a=1&amp;b=2'>", "a.x/2?a=1&b=2"),
    ("http://a.x/1", "<link rel=canonical href='mailto:b@c.x'><link rel=canonical href='#top'>", None),
])
def test_links_of_every_kind_carry_blocks(spark, url, html, target):
    pages = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    assert [r.b for r in urls.alias_edges(pages).collect()] == ([target] if target else [])
    if target:
        path = target[3:].partition("?")[0]
        other = spark.createDataFrame([(2, "http://" + target, None)], pages.schema)
        got = {r.page_id: r.verdict for r in urls.filter_urls(pages.union(other), [("a.x", path, "block")]).collect()}
        assert got == {1: "block", 2: "block"}


def test_url_filter_of_nothing(spark):
    assert urls.filter_urls(pages(spark, []), URL_RULES).collect() == []
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert urls.filter_urls(pages(spark, [(1, "http://a.net/es/", None)]), none).collect() == [(1, "a.net", "/es/", None, "allow")]


VECTORS = "vec_id long, embedding array<float>, label int, query_id long, rank int, score double, bits int, length int, vb int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 0.5, 4, 5, 6) for i, v in rows], VECTORS)


def brute(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            good[i] = min(good.get(i, v), v)
    d = max(set(map(len, good.values())), key=lambda n: (sum(len(v) == n for v in good.values()), -n), default=0)
    good = {i: v for i, v in good.items() if len(v) == d}
    out = []
    for q in good:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(good[q], good[i])), i) for i in good if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("d", [3, 24, 64])
def test_neighbours(spark, monkeypatch, d):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 150)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    r = np.random.default_rng(d)
    rows = [(i, [float(np.float32(x)) for x in r.standard_normal(d) * (1 + i % 3)]) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(60)]  # copies tie
    bad = [(700, None), (720, [0.0] * d), (740, [None] + [1.0] * (d - 1)), (760, [float("nan")] + [1.0] * (d - 1)), (780, [float("inf")] + [1.0] * (d - 1)),
           (None, [1.0] * d), (800, [1.0] * (d + 1)), (820, []), (40, rows[40][1]), (60, [-9.0] + rows[60][1][1:])]
    got = neighbours.nearest(vectors(spark, rows + bad)).collect()
    want = {(q, n): (i, s) for q, n, i, s in brute(rows + bad, 20, 20)}
    assert len(got) == len(want)
    assert all(want[x.query_id, x.rank][0] == x.vec_id and want[x.query_id, x.rank][1] == pytest.approx(x.score, abs=1e-12) for x in got)


def test_few_neighbours(spark):
    assert neighbours.nearest(vectors(spark, [])).collect() == []
    assert neighbours.nearest(vectors(spark, [(20, [1.0, 2.0])])).collect() == []
    assert neighbours.nearest(vectors(spark, [(1, [1.0, 2.0]), (3, [1.0, 1.0])])).collect() == []
    got = neighbours.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])])).collect()
    assert sorted((x.query_id, x.rank, x.vec_id, x.score) for x in got) == [(0, 1, 3, 4.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0)]


def test_codes_estimate_within_their_bound():
    r = np.random.default_rng(0)
    x, q, d = r.standard_normal((4000, 96)), r.standard_normal((20, 96)), 96
    centre = x.mean(0)
    turn = neighbours.rotations(d)
    bits, length, align = neighbours.encode(x, centre, turn)
    signs = np.unpackbits(bits, axis=1)[:, : len(turn)].reshape(len(x), -1, d) * 2.0 - 1
    parts = np.einsum("qrd,nrd->qnr", (q @ turn.T).reshape(len(q), -1, d), signs) / np.sqrt(d) * (length[:, None] / align)
    off = q @ centre[:, None] + parts.mean(2) - q @ x.T
    spread = length * np.sqrt((1 / align**2 - 1).sum(1)) / align.shape[1] / np.sqrt(d - 1)
    off /= np.linalg.norm(q, axis=1)[:, None] * spread
    assert abs(off.mean()) < 0.05 and 0.8 < off.std() < 1.1 and (np.abs(off) > neighbours.EPSILON).mean() < 1e-3
    # with the bound, few vectors are compared exactly
    *_, compared = neighbours.search_block(q, np.arange(-20, 0), x, np.arange(4000), bits, length, align, centre, 10)
    assert compared < 0.3 * 20 * 4000


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _archive_rows():
    r = random.Random(6)
    big = "".join(r.choice("abcé\n ") for _ in range(3000))
    html = ["<p>x</p>", "<p>x</p>", None, "", big, big + "!", big, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb", "WARC/1.1\r\n", "\r\n\r\n", "tail\r\n\r\n", "é" * 50, "WARC-Type: x\r\n"]
    rows = [(i, f"http://h/{i}\r\nX-Page-ID: 5", t) for i, t in enumerate(html)]
    return rows + [(None, None, "<p>x</p>"), (None, None, "only here"), (6, "http://again", big), (-7, "", "neg"), (20, "u", "only here twice"), (20, "u", "only here twice")]


@pytest.mark.parametrize("chunk", [7, 100, 1 << 16])
def test_archive_round_trip(spark, chunk):
    rows = _archive_rows()
    got = warc.archive_round_trip(pages(spark, rows), chunk).collect()
    top = {}
    for i, _, t in rows:
        top[t or ""] = max([x for x in (top.get(t or ""), i) if x is not None], default=None)
    want = []
    for i, _, t in rows:
        head, data = top[t or ""], (t or "").encode()
        later = head is not None and (i is None or i < head)
        want.append((i, len(data), _digest(data), "revisit" if later else "response", head if later else None))
    assert h.same(got, want)


def test_small_payloads_are_no_revisits(spark):
    got = warc.archive_round_trip(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), least=3).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_archives_are_well_formed(spark, tmp_path):
    """Records follow each other as their lengths say, and segments add up to the payloads."""
    rows = _archive_rows()
    out = str(tmp_path / "archive")
    warc.write_archive(pages(spark, rows), out, 500)
    found, parts = [], {}
    for name in os.listdir(out):
        if not name.endswith(".gz"):
            continue
        data = gzip.open(f"{out}/{name}").read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            head = dict(x.split(": ", 1) for x in lines[1:])
            size = int(head["Content-Length"])
            body = data[end + 4 : end + 4 + size]
            assert data[end + 4 + size : end + 8 + size] == b"\r\n\r\n" and size <= 500
            at = end + 8 + size
            if "WARC-Segment-Origin-ID" in head:
                parts.setdefault(head["WARC-Segment-Origin-ID"], []).append((int(head["WARC-Segment-Number"]), body, int(head["WARC-Segment-Total-Length"])))
            elif head["WARC-Type"] == "response":
                found.append(body)
    for p in parts.values():
        body = b"".join(x[1] for x in sorted(p))
        assert len(body) == p[0][2]
        found.append(body)
    assert {x for x in found} == {(t or "").encode() for _, _, t in rows}


def test_archive_of_nothing(spark):
    assert warc.archive_round_trip(pages(spark, [])).collect() == []
