import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evidara.operators import fusion as fu
from evidara.operators import selection as sl
from evidara.operators import stats as st


def test_bh_is_monotone_and_skips_nan(spark):
    p = [0.01, 0.04, 0.03, float("nan"), None, 0.9, 0.04]
    df = spark.createDataFrame(list(enumerate(p)), "id long, p double")
    q = {r.id: r.q for r in st.benjamini_hochberg(df, "p").collect()}
    assert q[3] is None and q[4] is None
    assert q[0] == pytest.approx(0.05) and q[1] == q[2] == q[6] == pytest.approx(0.05) and q[5] == pytest.approx(0.9)


def test_chi2_tails():
    assert st.chi2_sf(np.array([3.841458820694124]), 1)[0] == pytest.approx(0.05, abs=1e-9)
    assert st.chi2_sf(np.array([11.070497693516351]), 5)[0] == pytest.approx(0.05, abs=1e-9)
    assert st.chi2_sf(np.array([4.0]), 2)[0] == pytest.approx(math.exp(-2))


def test_kendall_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 12, 150).astype(float), rng.integers(0, 9, 150).astype(float)
    sa, sb = np.sign(a[:, None] - a), np.sign(b[:, None] - b)
    want = (sa * sb).sum() / math.sqrt((sa != 0).sum() * (sb != 0).sum())
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b}))
    assert st.kendall_tau(df, "a", "b").first()["tau"] == pytest.approx(want)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in list(range(201)) + [500, 501, 900]], "node long")
    got = {r.node: r.component for r in st.connected_components(edges, nodes).collect()}
    assert {got[i] for i in range(201)} == {0} and got[501] == 500 and got[900] == 900


def _quotas(counts, weights, target):
    total = sum(counts.values())
    if total <= target:
        return counts
    mass = sum(n * weights.get(b, 1.0) for b, n in counts.items())
    out = {b: max(1, int(n * weights.get(b, 1.0) / mass * target)) for b, n in counts.items()}
    for b in sorted(counts, key=lambda x: (weights.get(x, 1.0), x)):
        out[b] -= min(out[b] - 1, max(0, sum(out.values()) - target))
    for b in sorted(counts, key=lambda x: (-weights.get(x, 1.0), x)):
        out[b] += min(max(0, counts[b] - out[b]), max(0, target - sum(out.values())))
    return out


@pytest.mark.parametrize("target", [1, 4, 20, 60, 110, 500])
def test_quotas(spark, target):
    counts, weights = {"a": 100, "b": 10, "c": 1, "d": 7, "e": 30}, {"a": 1.0, "b": 2.0, "d": 0.1, "e": 2.0}
    table = spark.createDataFrame(list(counts.items()), "bin string, n long")
    got = sl.allocate_quotas(table, ["bin"], sl._weight(weights, "bin"), target)
    assert {r.bin: r.quota for r in got.collect()} == _quotas(counts, weights, target)


def test_balanced_sample_keeps_its_bounds(spark):
    rows = [(i, s) for s, n in (("x", 90), ("y", 30), ("z", 3)) for i in range(n)]
    df = spark.createDataFrame([(f"{s}{i}", s) for i, s in rows], "id string, species string")
    n = {r.species: r["count"] for r in sl.balanced_sample(df, "species", "id", 40, 5, 25, ["y"], {"x": 2.0}).groupBy("species").count().collect()}
    assert sum(n.values()) == 40 and n["y"] == 25 and n["z"] == 3 and n["x"] == 12
    for budget in (3, 20, 33):
        n = {r.species: r["count"] for r in sl.balanced_sample(df, "species", "id", budget, 5, 25, ["y"], {}).groupBy("species").count().collect()}
        want = {"x": 5, "y": 25, "z": 3}
        order = sorted(want, key=lambda x: (want[x], x), reverse=True)
        while sum(want.values()) > budget:
            for s in order:
                want[s] -= sum(want.values()) > budget and want[s] > 0
        assert n == {s: c for s, c in want.items() if c}


def test_slots_are_drawn_by_weight(spark):
    counts = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 5), ("d", 1000)], "s string, n long")
    taken = {"a": 0, "b": 0, "c": 0, "d": 0}
    for seed in range(6):
        got = sl.allocate_species(counts, "s", 400, 0, 900, [], sl._weight({"a": 3.0, "d": 0.0, "c": 50.0}, "s"), seed)
        for r in got.collect():
            taken[r.s] += r.take
    assert taken["c"] == 30 and taken["d"] == 0 and sum(taken.values()) == 2400
    assert 2.5 < taken["a"] / taken["b"] < 3.6


def test_greedy_spread(spark):
    rows = [("f", 0, "p1", "A", "1"), ("f", 1, "p1", "A", "1"), ("f", 2, "p1", "A", "2"), ("f", 3, "p2", "B", "3"), ("f", 4, "p2", "B", None), ("f", 5, "p3", "", ""),
            ("f", 6, None, "C", "1"), ("f", 7, "p1", "D", "1"), ("g", 8, "p1", "A", "1"), ("h", 9, "p9", "Z", "")]
    df = spark.createDataFrame(rows, "family string, id long, phylum string, class string, order string")
    held = spark.createDataFrame([("f", "phylum", "p1"), ("g", "order", "1"), ("g", "class", "A"), ("g", "phylum", "p1")], "family string, rank string, name string")
    got = [tuple(r) for r in sl.greedy_spread(df, "family", held, 2).orderBy("family", "pick").collect()]
    assert got == [("f", 3, 1, 1, 1, 1), ("f", 0, 2, 1, 1, 0), ("f", 2, 3, 1, 0, 0), ("f", 6, 4, 0, 1, 0), ("f", 5, 5, 0, 0, 1), ("h", 9, 1, 0, 1, 1)]
    assert sl.greedy_spread(df.limit(0), "family", None, 2).collect() == []


def test_degenerate_statistics(spark):
    one = spark.createDataFrame([("k", 1.0, True), ("k", 2.0, True)], "k string, v double, a boolean")
    r = st.mann_whitney(one, "v", st.F.col("a"), ["k"]).first()
    assert (r.n_a, r.n_b, r.z) == (2, 0, None)
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert st.kendall_tau(flat, "a", "b").first().tau is None
    none = spark.createDataFrame([], "m double")
    assert all(r.rejection != r.rejection for r in st.roc_youden(spark.createDataFrame([(0.5,)], "m double"), none, "m").collect())


def test_components_of_a_descending_path(spark):
    n = 200
    edges = spark.createDataFrame([(0, n)] + [(i, i - 1) for i in range(2, n + 1)], "a long, b long")
    got = st.connected_components(edges, spark.range(n + 2).withColumnRenamed("id", "node")).collect()
    assert {r.component for r in got if r.node <= n} == {0} and {r.component for r in got if r.node > n} == {n + 1}


def test_draws_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """Few narrow rows that become many draws do not stay in one task, and the resamples stay the same."""
    df = spark.createDataFrame([(i, float(i * 7 % 11), float(i % 3)) for i in range(60)], "id long, a double, b double").coalesce(1)
    plain = st.bootstrap_ci_diff(df, "a", "b", 30).collect()
    monkeypatch.setattr(st, "TASK_DRAWS", 100)
    assert st.tasks_for(60 * 30, df) >= 18
    assert [tuple(round(x, 9) for x in r) for r in st.bootstrap_ci_diff(df, "a", "b", 30).collect()] == [tuple(round(x, 9) for x in r) for r in plain]


def test_lists_as_columns_score_like_collected_lists(spark):
    rows = [(i % 3, i // 3, s, (i * (j + 3) % 17 + 1) / 17) for i in range(60) for j, s in enumerate("abcd") if (i + j) % 4]
    lists = spark.createDataFrame(rows, "scenario int, id long, list string, r double")
    keys = ["scenario", "id"]
    assert sorted(fu.rho_from_lists(lists, keys, list("abcd")).collect()) == sorted(fu.rho_from_lists(lists, keys).collect())


def test_resampled_ranks_of_repeated_and_undrawn_signals(spark):
    """An id without a drawn signal takes the last place, a repeated vote counts twice."""
    votes = spark.createDataFrame([(1, "a", 3.0), (1, "a", 2.0), (2, "b", 1.0), (2, "a", 1.0), (3, "b", 9.0), (None, "a", 0.5)], "id long, signal string, value double")
    ranks = fu.normalized_ranks(votes)
    wide = st.resampled_ranks(ranks, ["a", "b"], 6).collect()
    long = st.resampled_lists(ranks, ["a", "b"], 6).collect()
    assert len(wide) == 4 * 6 and sum(len(x.r) for w in wide for x in w.rs) == len(long)
    got = {r.id: r for r in st.bootstrap_rank_ci(votes, ["a", "b"], 1, 6).collect()}
    assert len(got) == 4 and got[None].rank_median == 4


def test_equal_places_are_their_own_percentile(spark):
    """One list alone gives every scenario the same places, and no bound falls below them."""
    votes = spark.createDataFrame([(i, "a", float(-i)) for i in range(150)], "id long, signal string, value double")
    got = {r.id: (r.rank_ci_lo, r.rank_ci_hi, r.rank_median) for r in st.bootstrap_rank_ci(votes, ["a"], 5, 20).collect()}
    assert got == {i: (i + 1, i + 1, i + 1) for i in range(150)}
