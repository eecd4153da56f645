"""Permutations without sorting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidara.functions.seats import seat_column, seats
from evidara.operators import stats as st


def test_every_draw_is_a_permutation_and_seats_are_even():
    for n in (1, 2, 3, 5, 17, 64, 65):
        got = seats(np.arange(n)[:, None], np.arange(50), n, 3)
        assert (np.sort(got, axis=0) == np.arange(n)[:, None]).all()
    n, draws = 10, 20_000
    got = seats(np.arange(n)[:, None], np.arange(draws), n, 0)
    counts = np.stack([np.bincount(row, minlength=n) for row in got])
    # chi-squared of 10 x 10 cells with 81 degrees of freedom
    assert ((counts - draws / n) ** 2 / (draws / n)).sum() < 130
    # neighbours do not stay neighbours
    assert abs(np.mean(np.abs(got[0] - got[1]) == 1) - 2 / n) < 0.02


def test_column_is_the_function(spark):
    rows = [(p, d, n) for n in (1, 4, 31) for d in range(6) for p in range(n)]
    df = spark.createDataFrame(rows, "p int, d int, n int").repartition(3)
    got = df.select("p", "d", "n", seat_column(F.col("p"), F.col("d"), F.col("n"), 5).alias("x")).collect()
    assert len(got) == len(rows) and all(r.x == seats(np.array([r.p]), np.array([r.d]), r.n, 5)[0] for r in got)


def test_enrichment_null_is_its_definition(spark, monkeypatch):
    monkeypatch.setattr(st, "SEATS_AT_ONCE", 64)
    n, perms, hits, k = 300, 40, [2, 5, 9, 30, 31, 250], 10
    order = spark.createDataFrame([(f"i{p}", p) for p in range(1, n + 1)], "id string, place int")
    positives = spark.createDataFrame([(f"i{p}",) for p in hits] + [("unknown",)], "id string")
    got = st.enrichment_null(order, positives, k, perms).first()
    drawn = 1 + seats(np.arange(len(hits))[:, None], np.arange(perms), n, 0)
    assert got.n_positives == len(hits) and got.observed_mean_rank == pytest.approx(np.mean(hits))
    assert got.p_value == pytest.approx((1 + (drawn.mean(0) <= np.mean(hits)).sum()) / (perms + 1))
    assert got.precision_at_k == pytest.approx(0.3)
    assert got.precision_p_value == pytest.approx((1 + ((drawn <= k).sum(0) >= 3).sum()) / (perms + 1))


def test_enrichment_null_of_nothing(spark):
    order = spark.createDataFrame([("a", 1), ("b", 2)], "id string, place int")
    got = st.enrichment_null(order, order.select("id").where("false"), 1, 5).first()
    assert got.n_positives == 0 and got.observed_mean_rank is None
    assert st.enrichment_null(order.where("false"), order.select("id"), 1, 5).first().n_positives == 0
    with pytest.raises(ValueError, match="places"):
        st.enrichment_null(order.where("place = 2"), order.select("id"), 1, 5)


def test_permuted_votes_move_the_ranks_of_each_signal(spark):
    rows = [(i, s, (i + 1) / n) for s, n in (("a", 40), ("b", 7), ("c", 1)) for i in range(n)]
    got = st.permuted_votes(spark.createDataFrame(rows, "id int, signal string, r double"), 30).collect()
    by = {}
    for r in got:
        by.setdefault((r.scenario, r.list), {})[r.id] = r.r
    assert len(by) == 90
    for (_, s), ranks in by.items():
        mine = {i: r for i, x, r in rows if x == s}
        assert ranks.keys() == mine.keys() and sorted(ranks.values()) == sorted(mine.values())
    # scenarios differ, and so do the orders two signals get in one scenario
    assert len({tuple(sorted(v.items())) for (_, s), v in by.items() if s == "a"}) == 30
    assert np.corrcoef([[by[p, "a"][i] for i in range(7)] for p in range(30)], [[by[p, "b"][i] for i in range(7)] for p in range(30)])[:30, 30:].diagonal().mean() < 0.5
