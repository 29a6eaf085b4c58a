"""One registered query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import block_naming, bpe, graph_dedup, hard_negatives, host_rules, language_id, mixing, quote_linking, simhash, substring_dedup, suffix_dedup, token_counts, whitening
from tributary.llm.common import ship
from tributary.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_table(spark, sf_dir, "documents"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(_table(spark, sf_dir, "documents"))


def op6_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_dedup.graph_dedup(_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op8_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_linking.quote_linking(_table(spark, sf_dir, "conversations")).drop("place")  # rows stay in its order


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(_table(spark, sf_dir, "documents")).drop("host_rate", "host_failed")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.block_naming(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_suffix_dedup, op3_token_counts, op4_language_id, op5_bpe_round_trip, op6_graph_dedup, op7_mixing, op8_quote_linking,
                                   op9_host_rules, op10_simhash, op11_hard_negatives, op12_whitening, op13_block_naming)}
