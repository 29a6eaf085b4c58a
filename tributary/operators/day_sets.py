"""A funnel that grows by days: exact distinct counts from bitmaps.

Users and sessions get numbers in a dictionary. A day keeps, for each stage, a
bitmap of the numbers it has seen (in pieces of 32,768 bits) and its totals, as
one partition. A report unites the days' bitmaps and counts bits: it reads a bit
for a user and day instead of the conversions, and counts a user of many days
once. Adding or replacing a day reads that day's conversions and the dictionary,
and no other day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.util import round_to
from ..streaming.tables import read_table, table_exists, write_incremental, write_table
from .reports import FUNNEL_STAGES, funnel_shares, stage_num_case

PARTS = 16  # independent number ranges of the dictionary: no task holds more than a part of the new keys
_RANGE = 1 << 40


def number_keys(spark: SparkSession, path: str, keys: DataFrame, parts: int = PARTS) -> DataFrame:
    """The dictionary (kind, key, id) under ``path`` with numbers for those of
    ``keys`` (kind, key; distinct) that are new. Numbers are dense within a
    part, so that bitmaps are full; known keys keep theirs."""
    new = keys.withColumn("part", F.pmod(F.xxhash64("kind", "key"), F.lit(parts)).cast("int"))
    if table_exists(spark, path):
        old = read_table(spark, path)
        new = new.join(old.select("kind", "key"), ["kind", "key"], "left_anti")
        used = old.groupBy("part").agg(F.max("id").alias("top"))
        new = new.join(used, "part", "left")
    else:
        new = new.withColumn("top", F.lit(None).cast("long"))
    at = F.row_number().over(Window.partitionBy("part").orderBy("kind", "key"))
    new = new.withColumn("id", F.coalesce("top", F.col("part") * F.lit(_RANGE)) + at).select("kind", "key", "part", "id")
    write_table(new, path, mode="append" if table_exists(spark, path) else "overwrite", partition_by=["part"])
    return read_table(spark, path)


def _keyed(conversions: DataFrame) -> DataFrame:
    stages = [s for s, _ in FUNNEL_STAGES]
    kinds = F.array(F.struct(F.lit("user").alias("kind"), F.col("user_pseudo_id").cast("string").alias("key")),
                    F.struct(F.lit("session").alias("kind"), F.col("conversion_session_id").cast("string").alias("key")))
    e = conversions.where(F.col("conversion_event").isin(*stages)).select(
        "event_date", stage_num_case(F.col("conversion_event")).alias("stage_num"), F.explode(kinds).alias("e"))
    return e.select("event_date", "stage_num", "e.kind", "e.key").where(F.col("key").isNotNull()).distinct()


def add_days(conversions: DataFrame, folder: str, dates: list[str]) -> None:
    """Bring the stored days ``dates`` up to date: their partitions are replaced."""
    spark, c = conversions.sparkSession, conversions.where(F.col("event_date").isin(*dates))
    keyed = _keyed(c)
    ids = number_keys(spark, f"{folder}/dictionary", keyed.select("kind", "key").distinct())
    seen = keyed.join(ids, ["kind", "key"])
    bits = seen.groupBy("event_date", "stage_num", "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    write_incremental(bits, f"{folder}/bits", "event_date", values=dates)
    totals = c.withColumn("stage_num", stage_num_case(F.col("conversion_event"))).where(F.col("stage_num").isNotNull()).groupBy("event_date", "stage_num").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("purchase_revenue_in_usd").cast("decimal(38,10)")).alias("usd"))
    write_incremental(totals, f"{folder}/totals", "event_date", values=dates)


def funnel_of_days(spark: SparkSession, folder: str, first: str, last: str) -> DataFrame:
    """The report of ``reports.purchase_funnel`` over the stored days."""
    days = F.col("event_date").between(first, last)
    sets = read_table(spark, f"{folder}/bits").where(days).groupBy("stage_num", "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = sets.groupBy("stage_num").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.bitmap_count("bits"))), F.lit(0)).alias(f"unique_{k}s") for k in ("user", "session")])
    totals = read_table(spark, f"{folder}/totals").where(days).groupBy("stage_num").agg(
        F.sum("events").alias("total_events"), round_to(F.sum("usd"), 2).alias("stage_revenue_usd"))
    names = F.element_at(F.array(*[F.lit(s) for s, _ in FUNNEL_STAGES]), F.col("stage_num").cast("int"))
    return funnel_shares(totals.join(counts, "stage_num", "left").withColumn("stage", names).fillna(0, ["unique_users", "unique_sessions"]))
