"""Writes into folders hold no sorted copy of a task's rows."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SESSION = """
import sys
root, out = sys.argv[1:3]
sys.path.insert(0, root)
from pyspark.sql import SparkSession, functions as F
conf = {"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{out}/shared",
        "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.dir": f"file://{out}/log"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
"""
SHARDS = """
from tributary.plans.catalog import shard_files
at = F.timestamp_micros(F.lit(1705363200000000) + F.col("id") * 300000000)
spark.range(3000).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 40).alias("user_id"), F.lit("purchase").alias("event_type"),
                         F.lit(2.5).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 97, F.lit("}")).alias("props")).write.parquet(f"{out}/sf/events.parquet")
spark.range(25).select(F.col("id").alias("n_nationkey"), F.lit("N").alias("n_name")).write.parquet(f"{out}/sf/nation.parquet")
days = spark.read.parquet(*[f"{shard_files(spark, f'{out}/sf')}/events_202401{d}" for d in (16, 21, 25)])
assert days.count() > 800
assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
"""


def most_memory(tmp_path, body):
    """Peak execution memory of any task, in bytes."""
    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", SESSION + body + "\nspark.stop()\n", ROOT, str(tmp_path)], check=True, timeout=300)
    ends = [json.loads(line) for log in (tmp_path / "log").iterdir() for line in log.read_text().splitlines() if "SparkListenerTaskEnd" in line]
    assert ends
    return max(e["Task Metrics"]["Peak Execution Memory"] for e in ends)


def test_day_tables_are_written_without_a_sort(tmp_path):
    assert most_memory(tmp_path, SHARDS) < 2 << 20


AUDITED = """
from tributary.streaming.tables import read_table, write_audited
mart = spark.range(3000).select((F.col("id") % 8).cast("string").alias("model"), F.repeat(F.lit("x"), 500).alias("path"), "id")
seen = write_audited(mart, f"{out}/mart", [F.count(F.lit(1)).alias("n")], lambda m: [], ["model"])
assert seen == {"n": 3000} and read_table(spark, f"{out}/mart").agg(F.sum("id")).first()[0] == 2999 * 1500
"""
MANY = """
from tributary.streaming.tables import read_table, write_table
write_table(spark.range(3000).withColumn("day", F.col("id") % 100), f"{out}/days", partition_by=["day"])
assert {tuple(r) for r in read_table(spark, f"{out}/days").collect()} == {(i, i % 100) for i in range(3000)}
"""


def test_audited_mart_is_written_without_a_sort(tmp_path):
    assert most_memory(tmp_path, AUDITED) < 2 << 20


def test_more_folders_than_open_files(tmp_path):
    most_memory(tmp_path, MANY)  # asserts inside: no row is lost where the writer turns to sorting
