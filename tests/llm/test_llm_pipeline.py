"""Every stage of the corpus pipeline against brute force on its own input."""

import hashlib

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F
from test_llm_repeats import brute_bytes
from test_llm_text import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, "null id " * 9, "en", None, 1), (None, "null id " * 9, "en", None, 1), (3, "again 3", "en", "src1", 1), (900, None, None, None, None), (901, "12 34", "en", "src1", 1), (902, "", "en", "src1", 1)]
    docs = docs.select(*P.COLUMNS).union(spark.createDataFrame(odd, docs.select(*P.COLUMNS).schema)).withColumns({"row": F.lit(1), "carried": F.lit(2)})
    out = [[r.asDict() for r in docs.collect()]]
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), f"test-{name}")
        out.append([r.asDict() for r in docs.collect()])
    return out


def test_columns(stages):
    for rows in stages[1:-1]:
        assert set(rows[0]) == set(P.COLUMNS)


def test_language_stage_rejects_only_texts_without_letters(stages):
    want = [r for r in stages[0] if r["text"] and any(c.isalpha() for c in r["text"])]
    assert sorted(str((r["doc_id"], r["text"])) for r in stages[1]) == sorted(str((r["doc_id"], r["text"])) for r in want)


def test_one_document_of_each_group_stays(stages):
    fps = [brute_fingerprint(r["text"]) for r in stages[1]]
    label = brute_groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    best = {}
    for g, r in zip(label, stages[1], strict=True):
        best[g] = min(best.get(g, (True, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in stages[2]) == sorted(best.values())


def test_repeated_bytes_go(stages):
    want = brute_bytes([r["text"] for r in stages[2]], 200)
    key = lambda i, t: (i is None, i or 0, t)
    assert sorted(key(r["doc_id"], r["text"]) for r in stages[3]) == sorted(key(r["doc_id"], w[3].decode(errors="ignore")) for r, w in zip(stages[2], want, strict=True))
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3])


def test_mix_comes_near_the_targets(stages):
    size, taken, largest = {}, {}, {}
    for r in stages[3]:
        n = len(r["text"].encode().split())
        size[r["source"]] = size.get(r["source"], 0) + n
        largest[r["source"]] = max(largest.get(r["source"], 0), n)
    for r in stages[4]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].encode().split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, left, free, want = {s: i % 3 + 1 for i, s in enumerate(order)}, float(sum(size.values())), set(size), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * size[s]} or set()
        want.update({s: 3.0 * size[s] if full else weight[s] * level for s in (full or free)})
        left -= sum(want[s] for s in full)
        free = free - full if full else set()
    assert all(abs(taken.get(s, 0) - want[s]) <= largest[s] / 2 + 1 for s in size)


def test_every_mixed_row_is_encoded(stages):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(r["decoded_sha256"] for r in stages[5]) == sorted(sha(r["text"]) for r in stages[4])


def test_empty_tables_and_tables_without_a_letter_run_through(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, df in (("none", docs.limit(0)), ("mute", docs.limit(3).withColumn("text", F.when(F.col("doc_id") % 2 == 0, "12 34")))):
        df.withColumns({"row": F.lit("r"), "kept": F.lit(1), "text_bytes": F.lit(None)}).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert P.run(spark, f"{tmp_path}/{name}").collect() == []


def test_one_document_with_a_very_long_text_runs_through(spark, tmp_path):
    text = "".join(f"word{i * 7919 % 1_000_003} " for i in range(300_000))
    spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    assert len(out) == 1 and out[0]["n_tokens"] > 300_000
