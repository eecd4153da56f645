import math

import numpy as np
import pytest

from evidara.operators import fusion as fu
from evidara.operators import stats as st


def brute_null(rho, m, n=400_000, seed=1):
    rng = np.random.default_rng(seed)
    u = np.sort(rng.random((n, m)), axis=1)
    best = np.ones(n)
    for k in range(1, m + 1):
        x = u[:, k - 1]
        best = np.minimum(best, sum(math.comb(m, j) * x**j * (1 - x) ** (m - j) for j in range(k, m + 1)))
    return (best <= rho).mean()


def test_null_for_one_list_is_rho():
    assert np.allclose(fu.null_pvalues(np.array([0.2, 0.7]), 1), [0.2, 0.7])


@pytest.mark.parametrize("m,rho", [(2, 0.1), (5, 0.03), (7, 0.2)])
def test_null_matches_simulation(m, rho):
    assert abs(fu.null_pvalues(np.array([rho]), m)[0] - brute_null(rho, m)) < 3e-3


def test_null_in_closed_form_for_two_lists():
    rho = np.array([1e-12, 1e-4, 0.03, 0.4, 0.99])
    first, second = 1 - np.sqrt(1 - rho), np.sqrt(rho)
    assert np.allclose(fu.null_pvalues(rho, 2), 2 * first * (1 - second) + rho, rtol=1e-9)


def test_null_is_monotone_and_keeps_tiny_values():
    x = np.array([0.0, 1e-19, 1e-9, 1e-3, 0.3, 0.9, 1.0])
    p = fu.null_pvalues(x, 6)
    assert (np.diff(p) > 0).all() and p[0] == 0 and p[-1] == 1
    assert 1e-19 < p[1] <= 6e-19


def test_scores_of_hand_made_votes(spark):
    votes = spark.createDataFrame([("a", "x", 3.0), ("b", "x", 2.0), ("c", "x", 2.0), ("a", "y", 1.0), ("c", "y", 5.0)], "id string, signal string, value double")
    r = {(x.id, x.signal): x.r for x in fu.normalized_ranks(votes).collect()}
    assert r[("a", "x")] == pytest.approx(1 / 3) and r[("b", "x")] == r[("c", "x")] == pytest.approx(2.5 / 3)
    assert r[("c", "y")] == 0.5 and r[("a", "y")] == 1.0
    rho = {x.id: (x.rho, x.m) for x in fu.rho_statistic(votes).collect()}
    assert rho["b"] == (pytest.approx(2.5 / 3), 1)
    assert rho["a"] == (pytest.approx(1 - (2 / 3) ** 2), 2)
    rrf = {x.id: x.score for x in fu.rrf_score(votes).collect()}
    assert rrf["a"] == pytest.approx(1 / 61 + 1 / 62)
    order = [x.id for x in fu.aggregate_order(votes).orderBy("place").collect()]
    assert sorted(order) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        fu.aggregate_order(votes, "mean")


def test_missing_flags_and_inversion(spark):
    df = spark.createDataFrame([("a", 1.0, True, 0.2), ("b", 0.0, True, None), ("c", 5.0, False, float("nan"))], "id string, s_score double, has_s bool, bad double".replace("bool", "boolean"))
    sig = [fu.Signal("s", flag="has_s"), fu.Signal("bad", "bad", invert=True), fu.Signal("gone", flag="has_gone"), fu.Signal("q", "s_score", "has_gone", optional_flag=True)]
    got = {(x.id, x.signal): x.value for x in fu.build_ranklists(df, sig).collect()}
    assert got == {("a", "s"): 1.0, ("b", "s"): 0.0, ("a", "bad"): 0.8, ("a", "q"): 1.0, ("b", "q"): 0.0, ("c", "q"): 5.0}


def test_vote_policy():
    w = {"a": 0.0, "b": 1.0}
    assert fu.VotePolicy(w, trust_orthogroups=True).excluded() == {"a"}
    assert fu.VotePolicy(w, "", True).excluded() == {"a"}
    assert fu.VotePolicy(w, " none ", True).excluded() == set()
    assert fu.VotePolicy(w, "b, c", True).excluded() == {"b", "c"}
    assert "expansion" in fu.VotePolicy(w).excluded()
    with pytest.raises(ValueError):
        fu.VotePolicy(w, "none,b").excluded()


def test_permutation_and_bootstrap_repeat(spark):
    rng = np.random.default_rng(0)
    rows = [(i, s, float(60 - i + rng.normal() * 3)) for i in range(60) for s in "abcd"]
    votes = spark.createDataFrame(rows, "id long, signal string, value double")
    one = st.permutation_null(votes, 5, 9).collect()
    assert one == st.permutation_null(votes, 5, 9).collect() and one[0]["p_value"] == pytest.approx(0.1)
    ci = {r.id: r for r in st.bootstrap_rank_ci(votes, list("abcd"), 10, 12).collect()}
    assert ci[0].rank_tier == "high" and ci[59].rank_tier == "tail"
    assert all(r.rank_ci_lo <= r.rank_median <= r.rank_ci_hi + 1 for r in ci.values())


def test_fused_rank_keeps_unscored_rows_at_the_tail(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.9), ("c", 0.5), ("d", 0.8), ("e", 0.5)], "id string, rank_score double")
    scores = spark.createDataFrame([("a", 0.01), ("c", 0.2), ("e", 0.2)], "id string, score double")
    got = [(r.id, r.rra_tied_block_size) for r in fu.fused_rank(df, scores).orderBy("final_rank").collect()]
    assert got == [("a", 1), ("c", 2), ("e", 2), ("b", 0), ("d", 0)]


def test_blank_text_is_missing_and_groups_take_column_names(spark):
    df = spark.createDataFrame([("a", " "), ("b", "2.5")], "id string, s_score string")
    assert [(r.id, r.value) for r in fu.build_ranklists(df, [fu.Signal("s")]).collect()] == [("b", 2.5)]
    assert fu.normalize_group_names({"s_score": "g", "t": "g"}) == {"s": "g", "t": "g"}


def test_ties_are_those_of_the_null_score(spark):
    """Before, the report counted equal statistics, and y tied with x and s, who hold one list only."""
    rows = [(i, s, 4.0 - n) for s, ids in (("a", "xypq"), ("b", "sytu")) for n, i in enumerate(ids)]
    votes = spark.createDataFrame(rows, "id string, signal string, value double")
    assert {r["id"]: r["rho"] for r in fu.rra_score(votes).collect() if r["id"] in "xys"} == pytest.approx({"x": 0.25, "y": 0.25, "s": 0.25})
    assert fu.saturation_report(votes).first().asDict() == pytest.approx({
        "n_candidates": 7, "n_saturated": 2, "fraction_saturated": 2 / 7, "largest_tie_block": 2, "n_tied": 6, "fraction_tied": 6 / 7,
        "n_distinct_scores": 4})
