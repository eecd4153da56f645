import numpy as np
import pandas as pd

from evidara.operators import intervals as iv


def test_loci_touching_and_chained(spark):
    rows = [(1, "c", 0, 10), (2, "c", 10, 20), (3, "c", 15, 30), (4, "c", 18, 19), (5, "c", 29, 40), (6, "d", 0, 5)]
    df = spark.createDataFrame(rows, "id long, chrom string, start long, end long")
    got = {r.id: (r.chrom, r.locus) for r in iv.interval_loci(df, ["chrom"], "id").collect()}
    assert got == {1: ("c", 1), 2: ("c", 2), 3: ("c", 2), 4: ("c", 2), 5: ("c", 2), 6: ("d", 1)}


def test_greedy_claim_equals_the_sequential_rule(spark):
    rng = np.random.default_rng(2)
    n = 400
    start = rng.integers(0, 3000, n)
    pdf = pd.DataFrame({"id": np.arange(n), "chrom": np.where(rng.random(n) < 0.7, "hot", "b"), "start": start, "end": start + rng.integers(1, 300, n), "score": rng.integers(0, 50, n).astype(float)})
    kept, want = [], {}
    for r in pdf.sort_values(["score", "id"], ascending=[False, True]).itertuples():
        def clash(k):
            shared = max(0, min(r.end, k.end) - max(r.start, k.start) + 1)
            return k.chrom == r.chrom and shared / (min(r.end - r.start, k.end - k.start) + 1) >= 0.3
        want[r.id] = not any(clash(k) for k in kept)
        if want[r.id]:
            kept.append(r)
    got = {r.id: r.kept for r in iv.greedy_locus_claim(spark.createDataFrame(pdf), "chrom", "id", "score", 0.3, 150).collect()}
    assert got == want


def test_column_mapping_stops_after_a_miss(spark):
    rows = [("g", "lenient", i + 1, c) for i, c in enumerate("abcab")] + [("g", "strict", i + 1, c) for i, c in enumerate("bab")]
    rows += [("h", "lenient", 1, "a"), ("h", "lenient", 2, "b"), ("h", "strict", 1, "z"), ("h", "strict", 2, "b")]
    df = spark.createDataFrame(rows, "og string, kind string, site long, content string")
    got = sorted((r.og, r.strict_site, r.lenient_site) for r in iv.map_columns(df, "og").collect())
    assert got == [("g", 1, 2), ("g", 2, 4), ("g", 3, 5), ("h", 1, None), ("h", 2, None)]


def test_segments_merge(spark):
    text = "K" * 10 + "L" * 25 + "K" * 6 + "L" * 25 + "K" * 60 + "l" * 30
    df = spark.createDataFrame([(1, text), (2, "KKK"), (3, None)], "id long, s string")
    got = sorted((r.start, r.end) for r in iv.hydropathy_segments(df, "id", "s").collect())
    vals = np.array([iv.HYDROPATHY[c.upper()] for c in text])
    hits = [i for i in range(len(text) - 20) if vals[i:i + 21].sum() / 21 >= 1.6 - 1e-12]
    want = [[hits[0], hits[0] + 21]]
    for h in hits[1:]:
        if h <= want[-1][1] or h - want[-1][1] < 8:
            want[-1][1] = h + 21
        else:
            want.append([h, h + 21])
    assert got == [tuple(w) for w in want]


def test_hot_queries_are_placed_like_the_others(spark, monkeypatch):
    """Lists and windows for queries of few rows, bins and ranges for hot ones: the same placements, repeated rows and missing keys too."""
    rows = [(q if q else None, "ac"[i // 2 % 2], 50 * (i * 7 % 9), 50 * (i * 7 % 9) + 30 * (i % 4) + 20, "+", 90.0 + i * 5 % 8, 50.0, f"m{i % 2}")
            for q in range(5) for i in range(4 + 6 * q)]
    df = spark.createDataFrame(rows + rows[:6], "query long, chrom string, start long, end long, strand string, identity double, coverage double, method string")

    def placed():
        a, b = df.where("method = 'm0'"), df.where("method = 'm1'")
        asked = spark.range(7).withColumnRenamed("id", "query")
        got = iv.concordant_placements(a, b, 91, 20, 40), iv.best_and_margin(df), iv.placement_cascade(asked, a, b, a, b, 91, 20, 0.5, 40)
        return [sorted(map(str, g.collect())) for g in got]

    plain = placed()
    by_hand = {x for x in rows if x[0] and x[5] >= 91 and any(
        y[0] == x[0] and y[7] != x[7] and y[1] == x[1] and x[2] < y[3] and y[2] < x[3] and 91 <= y[5] and (x[5] > y[5] or x[7] == "m0" and x[5] == y[5]) for y in rows)}
    assert len(plain[0]) == len(by_hand) > 0 and len(plain[1]) == 4 and len(plain[2]) == 7
    monkeypatch.setattr(iv, "LIST_ROWS", 12)
    monkeypatch.setattr(iv, "TASK_ROWS", 12)
    assert placed() == plain
