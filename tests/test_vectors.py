import numpy as np
import pytest

from evidara.operators import vectors as vc


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(240, 6))
    m[100:180] = m[100]  # a third of the references are copies
    rows = [(i, int(i % 4), [float(x) for x in v]) for i, v in enumerate(m)]
    return m, spark.createDataFrame(rows, "id long, label int, vec array<double>")


@pytest.mark.parametrize("block", [vc.BLOCK_VALUES, 200])
def test_nearest_is_exact_with_copies(data, monkeypatch, block):
    m, df = data
    monkeypatch.setattr(vc, "BLOCK_VALUES", block)
    got = vc.nearest(df.where("id < 30"), df.where("id >= 60").withColumnRenamed("id", "ref"), 5).orderBy("id", "rank").collect()
    for i in range(30):
        d = np.sqrt(((m[60:] - m[i]) ** 2).sum(axis=1))
        want = [int(j) + 60 for j in np.lexsort((np.arange(len(d)), np.round(d, 12)))[:5]]
        assert [r.ref for r in got if r.id == i] == want


def test_shrinkage_against_numpy(data):
    m, df = data
    x = m.copy()
    for c in range(4):
        x[np.arange(240) % 4 == c] -= x[np.arange(240) % 4 == c].mean(axis=0)
    n, p = x.shape
    cov = x.T @ x / n
    mu = np.trace(cov) / p
    d2 = ((cov - mu * np.eye(p)) ** 2).sum()
    b2 = sum(((np.outer(v, v) - cov) ** 2).sum() for v in x) / n**2
    s = min(b2, d2) / d2
    precision, shrink = vc.shrinkage_precision(df)
    assert shrink == pytest.approx(s)
    assert np.allclose(precision, np.linalg.inv((1 - s) * cov + s * mu * np.eye(p)))
    w = vc.whitening_matrix(precision)
    diff = m[0] - m[1]
    assert ((diff @ w) ** 2).sum() == pytest.approx(diff @ precision @ diff, rel=1e-6)


def test_prototypes_settle(data, spark):
    _, df = data
    protos = vc.family_prototypes(df, 3, 15).collect()
    assert {r.label for r in protos} == {0, 1, 2, 3} and len(protos) <= 12
    tiny = spark.createDataFrame([(1, 9, [1.0, 3.0]), (2, 9, [3.0, 5.0])], "id long, label int, vec array<double>")
    assert [r.vec for r in vc.family_prototypes(tiny, 3).collect()] == [[2.0, 4.0]]


def test_nearest_without_references(data):
    _, df = data
    got = vc.nearest(df.where("id < 3"), df.where("id < 0").withColumnRenamed("id", "ref"), 5)
    assert got.columns == ["id", "ref", "label", "dist", "rank"] and got.collect() == []


def test_vectors_that_are_not_measured_take_no_part(spark, data):
    m, df = data
    bad = spark.createDataFrame([(900, 0, None), (901, 1, []), (902, 2, [None] * 6), (903, None, [float("nan")] * 6), (904, 3, [float("inf")] * 6)], df.schema)
    mixed = df.union(bad)
    refs, more = df.withColumnRenamed("id", "ref"), mixed.withColumnRenamed("id", "ref")

    def rows(x):
        return sorted(map(str, x.collect()))

    assert rows(vc.nearest(mixed.where("id < 9 OR id >= 900"), more, 3)) == rows(vc.nearest(df.where("id < 9"), refs, 3))
    assert rows(vc.knn_novelty(mixed, more, 3)) == rows(vc.knn_novelty(df, refs, 3))
    assert rows(vc.family_prototypes(mixed)) == rows(vc.family_prototypes(df))
    precision, shrink = vc.shrinkage_precision(mixed)
    assert np.allclose(precision, vc.shrinkage_precision(df)[0])
    white = {r["id"]: r["vec"] for r in vc.whiten_vectors(mixed, vc.whitening_matrix(precision)).collect()}
    assert all(white[i] is None for i in range(900, 905)) and np.allclose(white[3], m[3] @ vc.whitening_matrix(precision))
    got = vc.mahalanobis_assign(mixed, vc.family_prototypes(mixed), precision)
    assert got.count() == 240 and vc.mahalanobis_assign(df, vc.family_prototypes(df), precision).count() == 240
    empty = df.limit(0)
    assert vc.shrinkage_precision(empty)[0].shape == (0, 0) and vc.nearest(df, empty.withColumnRenamed("id", "ref"), 2).count() == 0


def test_mahalanobis_assign_against_numpy(data):
    m, df = data
    precision, _ = vc.shrinkage_precision(df)
    protos = vc.family_prototypes(df).collect()
    for r in vc.mahalanobis_assign(df.where("id < 40"), vc.family_prototypes(df), precision).collect():
        d = sorted((float((x := m[r.id] - np.array(p.vec)) @ precision @ x), p.label) for p in protos)
        assert r.novelty == pytest.approx(d[0][0]) and r.family == d[0][1]


def test_few_distances_are_held_at_a_time(spark, data, monkeypatch):
    """Before, a batch of queries held its distances to all references at once."""
    m, df = data
    refs = df.withColumnRenamed("id", "ref")
    whole = [sorted(map(tuple, vc.nearest(df, refs, 4, how).collect())) for how in ("euclid", "cosine")]
    monkeypatch.setattr(vc, "TILE_VALUES", 700)
    monkeypatch.setattr(vc, "TASK_PAIRS", 5000)
    assert [sorted(map(tuple, vc.nearest(df, refs, 4, how).collect())) for how in ("euclid", "cosine")] == whole
    monkeypatch.setattr(vc, "BLOCK_VALUES", 300)
    got = vc.nearest(df, refs, 4).select("id", "ref", "rank").collect()
    far = ((m[:, None] - m[None]) ** 2).sum(axis=2)
    assert {(r["id"], r["rank"]): r["ref"] for r in got} == {(i, k + 1): int(j) for i in range(len(m)) for k, j in enumerate(np.argsort(far[i], kind="stable")[:4])}


def test_the_bar_is_a_distance_not_below_the_last_place(monkeypatch):
    """Before, every row of distances was put in order as far as its last place."""
    monkeypatch.setattr(vc, "STRIP", 4)
    rng = np.random.default_rng(5)
    for n in (3, 17, 50, 203):
        dist = rng.integers(0, 40, (9, n)).astype(float)
        for last in range(min(3, n)):
            bar, true = vc._at_least(dist, last), np.sort(dist, axis=1)[:, last]
            assert (bar >= true).all() and ((dist <= bar[:, None]).sum(axis=1) > last).all() and (dist == bar[:, None]).any(axis=1).all()
