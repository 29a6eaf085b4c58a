"""Exact dedup by block naming against brute force."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import block_naming as B

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows):
    texts = [(t or "").translate(LOWER) for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, texts, strict=True):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        ids = [x for x in groups[t] if x is not None]
        out.append((i, max(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(map(str, out))


def check(rows, got):
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == brute(rows)
    kept = [r for r in got if r["kept"]]
    assert len({r["text_sha256"] for r in kept}) == len(kept) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_block_naming_equals_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcÀé \n\0") for _ in range(rng.choice([0, 1, 7, 8, 9, 16, 63, 64, 65, 300, 2000]))) for _ in range(40)]
    texts = [None, None, "", "\0", "\0" * 8, "\0" * 9, "a", "a\0", "A", "İ", "i̇", "x" * 5000, "x" * 5001, "X" * 5000]
    for t in base:
        texts += [t] * rng.randrange(1, 4)
        texts += [t.upper(), t[:-1] + "z", "z" + t[1:], t + "\0", t[8:], t[:8] * 2]
    rows = [(rng.choice([None, i, i, i, 7]) if i > 20 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"chunk": F.lit(1), "kept": F.lit("x"), "bucket": F.lit(None)})
    for sizes in ({}, {"block": 8, "chunk_bytes": 700, "bucket_bytes": 400}):
        check(rows, B.block_naming(df, **sizes).collect())
    assert B.block_naming(df.limit(0)).collect() == []


def test_documents_equal_duckdb_and_a_hot_group_stays_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    hot = docs.limit(1).select("text").crossJoin(spark.range(3000)).select((F.col("id") + 10_000_000).alias("doc_id"), "text")
    df = docs.unionByName(hot.repartition(4))
    check([tuple(r) for r in df.collect()], B.block_naming(df, chunk_bytes=100_000).collect())


def test_names_differ_exactly_where_pairs_do():
    counts, names = np.array([1, 2, 3, 5]), np.arange(11).astype(np.uint64)
    keys, half = B.pairs(counts, names)
    assert half.tolist() == [1, 1, 2, 3]
    got = keys.view(">u8").reshape(-1, 2).tolist()
    none = int(B.NOTHING)
    assert got == [[0, none], [1, 2], [3, 4], [5, none], [6, 7], [8, 9], [10, none]]
    one, h, at = B.distinct(np.concatenate([keys, keys[::-1]]))
    assert len(one) == 7 and (np.sort(h) == h).all() and at[:7].tolist() == at[7:][::-1].tolist()
