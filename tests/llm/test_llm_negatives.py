"""Hard-negative mining against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import hard_negatives as H


def brute(rows, scale=256, every=100):
    ok = []
    for v, x, lab in rows:
        if v is not None and lab is not None and x and all(c is not None and np.isfinite(c) for c in x):
            x = [int(np.floor(scale * float(c))) for c in x]
            if sum(c * c for c in x) < 2 ** 62:
                ok.append((v, x, lab))
    out = []
    for i, (v, x, lab) in enumerate(ok):
        if v % every:
            continue
        met = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), w, m) for j, (w, y, m) in enumerate(ok) if i != j and len(x) == len(y))
        for s, w, _ in [r for r in met if r[2] == lab][:5]:
            inside = [r for r in met if r[2] != lab and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(v, w, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(inside)]
    return sorted(out)


def result(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 20))
    rows = [(i, (base[i % 6] + rng.normal(size=20) * rng.choice([0.0, 0.05, 0.5, 2.0])).tolist(), int(i % 5)) for i in range(700)]
    rows += [(i, rows[0][1], i % 3) for i in range(700, 900)]  # copies under several labels
    rows += [(1000, None, 1), (1100, [1.0, None], 1), (1200, [float("nan")] * 20, 1), (1300, [], 1), (1400, [float("inf")] * 20, 2), (1500, rows[0][1], None),
             (None, rows[0][1], 0), (1600, [0.0] * 20, 1), (1700, [1.0, 2.0], 1), (1701, [1.0, 2.0], 1), (1702, [1.0, 1.9], 2), (1800, [-1.0, -2.0], 3),
             (1900, [1e30] * 20, 1), (2000, [3e6] * 20, 1), (2001, [3e6] * 20, 1), (2002, [2.9e6] * 20, 2), (300, rows[300][1], rows[300][2]), (2100, rows[7][1], 77)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {"row": F.lit(1), "block": F.lit("b"), "dim": F.lit(None), "x": F.lit(2), "score": F.lit(3)})
    want = brute(rows)
    assert len(want) > 100
    for sizes in ({}, {"rows_per_tile": 100, "anchors_per_tile": 3, "turns": 1}):
        assert result(H.hard_negatives(df.repartition(3), **sizes)) == want
    assert H.hard_negatives(df.limit(0)).collect() == []


@pytest.mark.parametrize("turns", [1, 8])
def test_intervals_hold_every_product_and_spare_most(spark, turns):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 64)) / 8
    x = np.floor(256 * (base[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 64)) * 0.02)).astype(np.int32)
    code, align, length2, residual = H.encode(x, turns)
    rows = H.Rows.__new__(H.Rows)
    rows.code, rows.align, rows.length2, rows.residual = np.ascontiguousarray(code.T), align, length2, residual
    rows.ones, rows.norm = np.bitwise_count(rows.code).sum(axis=0).astype(float), np.linalg.norm(x.astype(float), axis=1)
    left = 0
    for q in x[:50]:
        low, high = H.Anchor(q, turns).interval(rows, slice(None))
        product = x.astype(np.int64) @ q.astype(np.int64)
        assert (low <= product).all() and (product <= high).all()
        left += (high >= H._threshold(low, 5)).mean() / 50
    assert left < (1.01 if turns == 1 else 0.1)
