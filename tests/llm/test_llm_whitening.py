"""Whitening against numpy's eigendecomposition, on exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import whitening as W


@pytest.mark.parametrize("kind", ["random", "equal", "zeros", "graded", "huge"])
def test_rank_one_terms_give_the_eigendecomposition(kind):
    rng = np.random.default_rng(1)
    d = 24
    values, vectors, a = np.zeros(d), np.eye(d), np.zeros((d, d))
    for step in range(200):
        u = rng.normal(size=d)
        if kind == "equal":
            u = np.eye(d)[step % d]
        elif kind == "zeros":
            u[rng.integers(0, d, 12)] = 0
            u[20:] = 0
        elif kind == "graded":
            u *= 10.0 ** -np.arange(d)
        elif kind == "huge":
            u *= 1e9 if step % 50 else 1e-3
        a += np.outer(u, u)
        values, vectors = W.add_rank_one(values, vectors, u)
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-12
    assert np.abs(vectors * values @ vectors.T - a).max() <= 1e-12 * np.abs(a).max()
    assert np.allclose(values, np.linalg.eigvalsh(a), rtol=1e-12, atol=1e-12 * values[-1])


def expected(x, components):
    """x: integers -> n, deviations, covariance, eigenvalues falling."""
    n, s = len(x), x.sum(axis=0)
    far = [[n * int(v) - int(t) for v, t in zip(r, s, strict=True)] for r in x]
    y = np.array(far, np.float64) / n
    cov = y.T @ y / n
    return n, [sum(v * v for v in r) for r in far], y, cov, np.linalg.eigvalsh(cov)[::-1]


def compare(out, ids, x, components=32):
    n, dev, y, cov, values = expected(x, components)
    many = min(components, x.shape[1])
    assert len(out) == n * many and {r["n"] for r in out} == {n}
    by = {}
    for r in out:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, many + 1))
    for r in out:
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) <= 1e-9 * r["explained"] + 1e-15
    white = np.full((n, many), np.nan)
    place = {i: k for k, i in enumerate(ids)}
    for r in out:
        white[place[r["vec_id"]], r["component"] - 1] = np.nan if r["whitened"] is None else r["whitened"]
        assert r["deviation"] == dev[place[r["vec_id"]]]
    live = ~np.isnan(white[0])
    w = white[:, live]
    assert np.abs(w.T @ w / n - np.eye(live.sum())).max() < 1e-9 and {r["identity_error"] < 1e-9 for r in out} == {True}
    axes = np.linalg.lstsq(y, w * np.sqrt(values[:many][live]), rcond=None)[0]  # directions back from the projections
    assert np.abs(cov @ axes - axes * values[:many][live]).max() < 1e-8 * values[0]
    return live


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(800, 12)) * np.geomspace(3, 0.05, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0] + 5
    v[300:600] = v[0]  # a large group of copies
    rows = [(i, r.tolist()) for i, r in enumerate(v)]
    bad = [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] * 12), (904, [float("inf")] * 12), (905, [1.0, 2.0]), (906, [1e12] * 12)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(40).withColumns(
        {"id": F.lit("a"), "component": F.lit(1), "n": F.lit(None), "gram": F.lit(0)})
    live = compare(W.whiten(df).collect(), range(800), np.floor(64 * v).astype(np.int64) + 1_000_000)
    assert live.all()
    assert len(W.whiten(df, components=3).collect()) == 2400


def test_directions_without_variance_are_null(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(5, 8))
    v[:, 2] = 1
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<float>")
    live = compare(W.whiten(df).collect(), range(5), np.floor(64 * v.astype(np.float32).astype(np.float64)).astype(np.int64) + 1_000_000)
    assert live.sum() == 4
    one = W.whiten(df.limit(1)).collect()
    assert len(one) == 8 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, None, None, None)}
    same = W.whiten(df.limit(1).union(df.limit(1)).withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert len(same) == 16 and {r["vec_id"] for r in same} == {None}
    assert W.whiten(df.limit(0)).collect() == []


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    x = np.array([np.floor(64 * np.array(e, np.float64)) for _, e in rows]).astype(np.int64) + 1_000_000
    assert compare(W.whiten(df).collect(), [i for i, _ in rows], x).all()


def test_large_integers_stay_exact():
    x = np.array([[2 ** 31 + 3, 5], [7, -2 ** 31]], np.int64)
    n, sums = 2 ** 40, np.array([11, 13], np.int64)
    far = W.centred(x, n, sums)
    assert far.tolist() == [[n * (2 ** 31 + 3) - 11, 5 * n - 13], [7 * n - 11, -n * 2 ** 31 - 13]]
    assert W.deviations(far) == [None, None] and W.deviations(np.array([[2 ** 31, 1]], np.int64)) == [2 ** 62 + 1]
