"""Substring and suffix-array dedup against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tributary.llm import substring_dedup, suffix_dedup


def brute_words(texts, n):
    docs = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + n]) for w in docs for i in range(len(w) - n + 1))
    out = []
    for w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = [True] * n
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def brute_bytes(texts, n):
    docs = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + n] for d in docs for i in range(len(d) - n + 1))
    out = []
    for d in docs:
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        out.append((len(d), sum(gone), sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1])), bytes(x for x, g in zip(d, gone, strict=True) if not g)))
    return out


def planted(seed):
    """Random texts with shared passages, copies, edits, runs and periodic stretches."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = [prose(rng.randrange(10, 90)) for _ in range(6)]
    texts = [None, "", " \n ", "x" * 1500, "x" * 700, "ab" * 400, "ab " * 300, prose(3)]
    for _ in range(60):
        texts.append(" ".join(rng.choice([prose(rng.randrange(0, 40)), rng.choice(passage)]) for _ in range(rng.randrange(1, 6))))
    for t in rng.sample(texts[8:], 20):
        w = t.split(" ")
        w[rng.randrange(len(w))] = word()
        texts += [t, " ".join(w), t[rng.randrange(3):], t + "\n"]
    texts.append(prose(1) + passage[0] * 3)
    rng.shuffle(texts)
    return texts


def frame(spark, texts, parts=3):
    rows = [(i, t, "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(parts).withColumns({"n_bytes": F.lit(1), "chunk": F.lit(2)})


@pytest.mark.parametrize("seed,window,chunk", [(1, 35, 4 << 20), (2, 35, 3000), (3, 8, 1)])
def test_substring_dedup_equals_brute_force(spark, seed, window, chunk):
    texts = planted(seed)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.substring_dedup(frame(spark, texts), window, chunk).collect()}
    assert got == dict(enumerate(brute_words(texts, window)))
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("seed,most,chunk", [(1, 1 << 16, 4 << 20), (2, 1 << 16, 3000), (3, 1, 5000), (4, 3, 1 << 20)])
def test_suffix_dedup_equals_brute_force(spark, seed, most, chunk):
    texts = planted(seed)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.suffix_dedup(frame(spark, texts), most=most, chunk_bytes=chunk).collect()}
    assert got == dict(enumerate(brute_bytes(texts, 200)))
    assert any(v[1] for v in got.values())


def test_repeats_in_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    texts, ids = [r["text"] for r in rows], [r["doc_id"] for r in rows]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == dict(zip(ids, brute_words(texts, 35), strict=True))
    got = {r["doc_id"]: r for r in suffix_dedup.suffix_dedup(docs, carry=("lang", "source")).collect()}
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for i, r in got.items()} == dict(zip(ids, brute_bytes(texts, 200), strict=True))
    assert {i: r["carried"]["source"] for i, r in got.items()} == {r["doc_id"]: r["source"] for r in docs.collect()}


def test_tiles_and_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    long = " ".join(str(rng.randrange(10 ** 6)) for _ in range(30000))
    texts = [long, long[50000:120000] + "!", "tail " + long[-300:], "z" * 140000]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.suffix_dedup(frame(spark, texts, 1)).collect()}
    assert got == dict(enumerate(brute_bytes(texts, 200)))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.substring_dedup(frame(spark, texts, 1)).collect()}
    assert got == dict(enumerate(brute_words(texts, 35)))


def test_ties_and_empty(spark):
    rows = [(None, "a b " * 100), (None, "a b " * 100), (7, None), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(df).collect()) == [(0, 0), (0, 0), (200, 200), (200, 200)]
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.suffix_dedup(df).collect()) == [(0, 0, 0)] * 2 + [(400, 400, 1)] * 2
    assert substring_dedup.substring_dedup(df.limit(0)).count() == 0
    assert suffix_dedup.suffix_dedup(df.limit(0)).count() == 0


def thue_morse(n):
    return ["ab"[bin(i).count("1") % 2] for i in range(n)]


def test_words_that_defeat_polynomial_hashes_are_told_apart(spark):
    """Thue-Morse strings and their complements have equal polynomial hashes modulo 2^64, whatever the odd base."""
    one = "".join(thue_morse(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    short = [f"w{i}" for i in range(34)]
    texts = [" ".join([*short, one]), " ".join([*short, other]), " ".join([*short, one[:400]]), " ".join([*short, other[:400]]), " ".join([one, *short]), " ".join([one, *short])]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.substring_dedup(frame(spark, texts)).collect())
    assert got == [(i, *w) for i, w in enumerate(brute_words(texts, 35))]
    assert [g[2] for g in got] == [0, 0, 0, 0, 35, 35]


def test_word_hashes_know_bytes_and_length_only():
    import numpy as np

    words = [b"a", b"a\0", b"ab", b"\0a", b"abcdefgh", b"abcdefgh\0", b"abcdefghi", b"x" * 511, b"x" * 512, b"x" * 513, b"x" * 600, b"x" * 599 + b"y"]
    content = np.frombuffer(b"\n".join(words + words[::-1]), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words + words[::-1]]) - 1
    start = end - [len(w) for w in words + words[::-1]]
    h, g = (substring_dedup.word_hashes(content, start, end, s) for s in (1, 2))
    assert len(set(h.tolist())) == len(words) and not set(h.tolist()) & set(g.tolist())
    assert h[:12].tolist() == h[12:][::-1].tolist()


def test_chunk_tables_grow_in_buckets_and_are_released(spark):
    import os

    from tributary.llm import chunks, common

    common.release(spark)
    df = frame(spark, ["some text " * 50] * 40 + [None])
    many = chunks.pack(df, b"\n", chunk_bytes=16)
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {spark.sparkContext._tributary_scratch[-1][1]}").filter("col_name = 'Num Buckets'").first()["data_type"])
    assert buckets == -(-40 * 500 // (64 * 16)) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert many.count() == 41 or many.agg(F.sum(F.size("doc_ids"))).first()[0] == 41
    out = substring_dedup.substring_dedup(df).count()
    paths = [p for p, _ in spark.sparkContext._tributary_scratch]
    assert out == 41 and len(paths) >= 4
    assert common.release(spark) == len(paths) and common.release(spark) == 0
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_chunks_")]
