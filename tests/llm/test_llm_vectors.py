"""Embedding near-dedup against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import graph_dedup


def brute(rows, threshold=0.93):
    ok = [i for i, (v, x, lab) in enumerate(rows) if v is not None and lab is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links, group = [0] * len(rows), list(range(len(rows)))
    for a in ok:
        for b in ok:
            if b < a and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                p, q = (np.array(rows[i][1], np.float64) for i in (a, b))
                if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    x, y = group[a], group[b]
                    group = [min(x, y) if g in (x, y) else g for g in group]
    low = {}
    for i in ok:
        low[group[i]] = min(rows[i][0], low.get(group[i], rows[i][0]))
    return [(r[0], links[i], low[group[i]] if i in set(ok) else r[0]) for i, r in enumerate(rows)]


def test_graph_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):
        base = rng.normal(size=16)
        for _ in range(12):
            rows.append((base + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.3, 1.0]), c % 3))
    rows = [(i, [float(np.float32(v)) for v in x], lab) for i, (x, lab) in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [1.0, None], 1), (n + 3, [float("nan")] * 16, 1), (n + 4, [], 1), (n + 5, rows[0][1], None),
             (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (None, rows[0][1], 0), (5, rows[5][1], rows[5][2]), (n + 8, [1e-30, 2e-30], 1), (n + 9, [float("inf"), 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"node": F.lit(1), "links": F.lit(2), "cluster": F.lit(1)})
    real = [(r[0], None if r[1] is None else list(r[1]), r[2]) for r in df.collect()]
    want = sorted(brute(real), key=str)
    for sizes in ({}, {"shard_size": 32, "block": 24, "sample": 256}):
        out = graph_dedup.graph_dedup(df, **sizes).collect()
        assert out[0]["recall"] >= 0.98
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == want
        assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in out)
    assert graph_dedup.graph_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_graph_dedup_on_embeddings(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()]
    out = graph_dedup.graph_dedup(df, shard_size=16, block=32).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == sorted(brute(rows))


def sparse_beside_dense(dense=500, pairs=500, dim=64, cosine=0.945):
    """A third of the vectors near copies of one another, the others in pairs."""
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    one = unit(rng.normal(size=(pairs, dim)))
    side = rng.normal(size=(pairs, dim))
    side = unit(side - (side * one).sum(axis=1, keepdims=True) * one)
    group = unit(rng.normal(size=dim)) + 0.01 * rng.normal(size=(dense, dim))
    return np.concatenate([group, one, cosine * one + np.sqrt(1 - cosine ** 2) * side])


def test_labels_that_fail_to_the_last_are_searched_exactly(spark):
    x = sparse_beside_dense(dense=100, pairs=150)
    df = spark.createDataFrame([(i, v.tolist(), i % 2 if i < 100 else 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = graph_dedup.graph_dedup(df, overlaps=(1,), shard_size=8, block=32, least_recall=1.0, audited=400).collect()
    want = brute([(i, v.tolist(), i % 2 if i < 100 else 0) for i, v in enumerate(x)])
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want and got[0]["recall"] == 1


def test_judge_counts_vectors_not_links():
    truth = {i: (("a", 2), 10000) for i in range(170)} | {i: (("a", 2), 1) for i in range(170, 500)} | {500: (("b", 2), 0)}
    found = {n: t for n, (_, t) in truth.items()} | dict.fromkeys(range(170, 200), 0)
    lowest, failed = graph_dedup.judge(truth, found, 0.98)
    assert failed == {("a", 2)} and lowest == 300 / 330
    assert graph_dedup.judge(truth, {n: t for n, (_, t) in truth.items()}, 0.98) == (1.0, set())
