"""A corpus pipeline over ``documents``: language ID, SimHash near-dedup,
suffix-array dedup, mixing sources, byte-level BPE.

Every stage takes the documents that the one before kept and, but for the
last, returns the columns of documents. Null and empty texts leave with the
first stage; rows with equal ids are documents of their own throughout. Texts
of any length pass whole. An empty table gives an empty result at every stage;
extra columns are not read. Where rows of a group tie for the smallest id, the
first one read stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.bpe import bpe_round_trip
from tributary.llm.common import ship, written
from tributary.llm.language_id import UNKNOWN, language_id
from tributary.llm.mixing import mixed_rows
from tributary.llm.simhash import simhash_groups
from tributary.llm.suffix_dedup import suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected (no text, or no letter in it) go."""
    return language_id(docs, carry=COLUMNS).filter(F.col("lang_pred") != UNKNOWN).select("carried.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays (null
    last; of rows with equal ids the first). Rows are numbered in a written
    table, so that equal and null ids stay apart."""
    rows = written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    groups = simhash_groups(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = groups.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte repeats go out of the texts; the documents stay, an emptied one with an empty text."""
    kept = suffix_dedup(docs, carry=("lang", "source"), as_text=True)
    return kept.select("doc_id", F.col("kept").alias("text"), "carried.lang", "carried.source", F.length("kept").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it, from 0 to 3 times."""
    return mixed_rows(docs, carry=COLUMNS).select("carried.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents."""
    return bpe_round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeated_bytes),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL cannot express kernels, XXH64 or BPE; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
