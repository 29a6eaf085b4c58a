"""Registered queries: names, the entry's guard, and DuckDB's results."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_for_each_operator_and_the_pipeline():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(E.LLM_ORACLES))
def test_query_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of(names, want.fetchall())


def test_quotes_equal_duckdb(spark, tmp_path):
    rows = [(1, 0, "user", "How do I sort?\nThanks"), (1, 1, "assistant", "Use sorted().\nok"),
            (1, 2, "user", "On Monday someone wrote:\n>  How do I  SORT?\n\nSame question\nok"),
            (1, 3, "user", "> > How do I sort?\n> Use sorted().\n>> ok\nBut stable?"), (1, 4, None, None),
            (1, 5000, "user", "> never said\n> ok\nhello"), (2, None, "user", "> a"), (None, 1, "user", "b"), (3, 7, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    out = E.queries()["op8_quote_linking"](spark, str(tmp_path))
    want = con.execute(E.oracle_sql()["op8_quote_linking"])
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())


def test_entry_works_without_the_subpackage():
    code = ("import sys\nclass Gone:\n    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('tributary.llm') or name == 'corpus_pipeline':\n            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\nimport __spark_entry__ as e\n"
            "q = e.queries()\nassert 'cross_channel' in q and not any(n.startswith('op') or n == 'pipeline' for n in q)\nassert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_pipeline_query_equals_its_stages(spark):
    out = E.queries()["pipeline"](spark, SF)
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} and out.count() > 0
