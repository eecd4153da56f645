import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evidara import ordering as od


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group, a third of the values equal."""
    rng = np.random.default_rng(3)
    n = 3000
    g = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str))
    v = np.where(rng.random(n) < 0.34, 0.0, np.round(rng.normal(size=n), 2))
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("ranges", [2, 8, 64])
def test_average_ranks(hot, ranges):
    pdf, df = hot
    got = od.ranked(df, ["g"], "v", "rank", descending=True, ranges=ranges).toPandas().set_index("id")["rank"]
    want = pdf.set_index("id").groupby("g")["v"].rank(ascending=False)
    assert (got.sort_index() - want.sort_index()).abs().max() == 0


@pytest.mark.parametrize("ranges", [2, 64])
def test_running_sums_and_extremes(hot, ranges):
    pdf, df = hot
    got = od.running(df, ["g"], ["v", "id"], {
        "before": od.Scan("sum", F.col("id"), "before"), "top": od.Scan("max", F.col("id"), "upto"), "low": od.Scan("min", F.col("id"), "from"),
    }, ranges=ranges).toPandas().set_index("id").sort_index()
    o = pdf.sort_values(["g", "v", "id"])
    run = o.groupby("g")["id"]
    o["before"] = run.cumsum() - o["id"]
    o["top"] = run.cummax()
    o["low"] = o[::-1].groupby("g")["id"].cummin()
    o = o.set_index("id").sort_index()
    assert (got["before"].fillna(0) == o["before"]).all()
    assert (got["top"] == o["top"]).all() and (got["low"] == o["low"]).all()


def test_percentiles_interpolate(hot):
    pdf, df = hot
    got = od.percentiles(df, ["g"], "v", {"a": 0.05, "b": 0.5}).toPandas().set_index("g")
    want = pdf.groupby("g")["v"].quantile([0.05, 0.5]).unstack()
    assert np.allclose(got.loc[want.index, ["a", "b"]].to_numpy(dtype=float), want.to_numpy())


def test_row_numbers_are_a_permutation(hot):
    _, df = hot
    got = od.row_numbers(df, [], ["v", "id"], "k", ranges=16).toPandas()
    assert sorted(got["k"]) == list(range(1, len(got) + 1))
    assert (got.sort_values("k")[["v", "id"]].apply(tuple, axis=1).is_monotonic_increasing)


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, g string, v double")
    assert od.ranked(df, ["g"], "v").count() == 0
    assert od.percentiles(df, ["g"], "v", {"a": 0.5}).count() == 0


def test_many_borders_travel_as_data(spark, monkeypatch):
    import random

    r = random.Random(2)
    rows = [(f"g{r.randrange(3)}", i, r.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    want = [tuple(x) for x in od.row_numbers(df, ["g"], ["v", "i"], ranges=40).orderBy("i").collect()]
    monkeypatch.setattr(od, "LITERAL_BORDERS", 5)
    assert [tuple(x) for x in od.row_numbers(df, ["g"], ["v", "i"], ranges=40).orderBy("i").collect()] == want


@pytest.mark.parametrize("ranges", [9, 65, 150])
def test_ranges_follow_the_order(spark, ranges):
    rows = [(None if i % 11 == 0 else f"g{i % 3}", None if i % 7 == 0 else float("nan") if i % 13 == 0 else i % 50 / 4, i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v double, id long")
    got = od.with_range(df, ["g", "v", "id"], ranges)
    seen = [r["__range"] for r in got.orderBy("g", "v", "id").collect()]
    assert seen == sorted(seen) and set(seen) == set(range(ranges))
    if ranges <= od.TREE_BORDERS + 1:
        # found by comparisons that Spark compiles, not by a walk over an array for each row
        assert "filter(" not in got._jdf.queryExecution().executedPlan().toString()
