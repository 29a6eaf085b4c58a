"""Ad-platform cost readers normalised to the 7-column daily cost fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MICROS_PER_DAY
from ..functions.channels import channel_grouping_19

COST_SCHEMA = ("date date, channel string, campaign string, cost_usd double, impressions bigint, "
               "clicks bigint, source_system string")
COST_COLUMNS = ("date", "channel", "campaign", "cost_usd", "impressions", "clicks", "source_system")

# --- fixed values -----------------------------------------------------------------
# Google Ads advertising-channel type -> channel (unlisted types: Non-Brand).
GOOGLE_ADS_CHANNEL_TYPES = (
    ("SEARCH", "Paid Search Non-Brand"), ("DISPLAY", "Display"), ("SHOPPING", "Paid Shopping"),
    ("VIDEO", "Paid Video"), ("PERFORMANCE_MAX", "Cross-network"),
)
GOOGLE_ADS_DEFAULT_CHANNEL = "Paid Search Non-Brand"
# Fixture cost (FIXTURES.md §5): paid channel -> platform; others google_ads.
PAID_CHANNELS = ("Cross-network", "Paid Search Brand", "Paid Search Non-Brand", "Paid Shopping",
                 "Paid Social", "Paid Video", "Display")
FIXTURE_PLATFORMS = (("Paid Social", "meta_ads"), ("Paid Video", "tiktok"), ("Display", "linkedin"))
# ----------------------------------------------------------------------------------


def empty_cost(spark: SparkSession) -> DataFrame:
    """Zero-row cost table (a platform with no data wired in)."""
    return spark.createDataFrame([], COST_SCHEMA)


def normalise_cost(df: DataFrame, source_system: str | None = None) -> DataFrame:
    """Select the 7 columns with their types and apply the null guard on
    date, channel and cost."""
    ss = F.lit(source_system) if source_system else F.col("source_system")
    out = df.select(
        F.col("date").cast("date").alias("date"), F.col("channel").cast("string").alias("channel"),
        F.col("campaign").cast("string").alias("campaign"), F.col("cost_usd").cast("double").alias("cost_usd"),
        F.col("impressions").cast("bigint").alias("impressions"), F.col("clicks").cast("bigint").alias("clicks"),
        ss.cast("string").alias("source_system"),
    )
    return out.where(F.col("date").isNotNull() & F.col("channel").isNotNull() & F.col("cost_usd").isNotNull())


def read_cost(spark: SparkSession, path: str | None, source_system: str, fmt: str = "parquet",
              options: dict | None = None) -> DataFrame:
    """Read one platform's daily cost (parquet/csv/json/...); ``path=None``
    yields the zero-row placeholder."""
    if path is None:
        return empty_cost(spark)
    r = spark.read.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return normalise_cost(r.load(path), source_system)


def read_cost_google(spark, path=None, fmt="parquet", options=None) -> DataFrame:
    return read_cost(spark, path, "google_ads", fmt, options)


def read_cost_meta(spark, path=None, fmt="parquet", options=None) -> DataFrame:
    return read_cost(spark, path, "meta_ads", fmt, options)


def read_cost_other(spark, path=None, fmt="parquet", options=None, source_system: str = "other") -> DataFrame:
    return read_cost(spark, path, source_system, fmt, options)


def google_ads_channel_map(channel_type) -> Column:
    ct = F.col(channel_type) if isinstance(channel_type, str) else channel_type
    expr = None
    for t, ch in GOOGLE_ADS_CHANNEL_TYPES:
        expr = F.when(ct == t, ch) if expr is None else expr.when(ct == t, ch)
    return expr.otherwise(GOOGLE_ADS_DEFAULT_CHANNEL)


def google_ads_cost(raw: DataFrame) -> DataFrame:
    """Google Ads transfer rows (date, advertising channel type, campaign
    name, cost_micros, impressions, clicks) -> cost fact."""
    return normalise_cost(raw.select(
        F.col("date"), google_ads_channel_map("campaign_advertising_channel_type").alias("channel"),
        F.col("campaign_name").alias("campaign"), (F.col("cost_micros") / F.lit(1e6)).alias("cost_usd"),
        "impressions", "clicks"), "google_ads")


def fixture_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost derived from the mapped events (FIXTURES.md §5): one row per
    date x paid channel x campaign; cost = round(sum(value) * 0.1, 2),
    impressions = count * 100, clicks = count * 7."""
    from .fixtures import fixture_base
    ev = fixture_base(spark, sf_dir)
    ch = channel_grouping_19(F.coalesce("medium", F.lit("(none)")), F.coalesce("source", F.lit("(direct)")),
                             F.coalesce("campaign", F.lit("")))
    platform = None
    for c, p in FIXTURE_PLATFORMS:
        platform = F.when(F.col("channel") == c, p) if platform is None else platform.when(F.col("channel") == c, p)
    platform = platform.otherwise("google_ads")
    e = ev.select(F.date_from_unix_date(F.floor(F.col("event_timestamp") / F.lit(MICROS_PER_DAY)).cast("int"))
                  .alias("date"), ch.alias("channel"), F.coalesce("campaign", F.lit("")).alias("campaign"), "_value")
    # The paid-channel test is kept as an aggregate flag and applied to the
    # aggregated rows: as a row filter the optimizer would push it under the
    # mapping projection and re-evaluate the whole channel CASE (and the
    # property parse inside it) once per reference, per row.
    agg = e.groupBy("date", "channel", "campaign").agg(
        F.round(F.sum(F.col("_value").cast("decimal(38,10)")) * F.lit(0.1).cast("decimal(2,1)"), 2)
        .cast("double").alias("cost_usd"),
        (F.count(F.lit(1)) * 100).alias("impressions"), (F.count(F.lit(1)) * 7).alias("clicks"),
        F.max(F.col("channel").isin(*PAID_CHANNELS)).alias("_paid"),
        F.max(platform).alias("source_system"))  # constant per channel
    return agg.where(F.col("_paid")).select(*COST_COLUMNS)


def fixture_cost_by_platform(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(google, meta, other) cost readers' outputs over the fixture cost."""
    c = fixture_cost(spark, sf_dir)
    return (normalise_cost(c.where(F.col("source_system") == "google_ads")),
            normalise_cost(c.where(F.col("source_system") == "meta_ads")),
            normalise_cost(c.where(F.col("source_system").isin("tiktok", "linkedin"))))
