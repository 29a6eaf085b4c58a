"""Documented BI recipes as DataFrame queries over the marts.

Each is a small aggregate over an already-reduced layer; windows without a
partition only run over aggregated rows bounded by the dimension sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.util import exact_sum, round_to, safe_div, utc_date
from .models import RULE_MODELS


def _money(c: str, digits: int = 6):
    """Exact sum of a money/credit column rounded to ``digits`` (the recipes
    leave these unrounded; 6 decimals is lossless for 2-dp values x 4-dp
    credits and makes totals independent of row order)."""
    return round_to(exact_sum(c), digits)


def model_summary(mart: DataFrame) -> DataFrame:
    """Per model of the counted mart: conversions, credit, revenue, avg value per credit, channels."""
    _ratio = safe_div(F.col("attributed_value_usd"), F.col("attributed_credit"))
    return mart.groupBy("model").agg(
        F.sum("first_of_model").alias("conversion_count"),
        _money("attributed_credit").alias("total_credited_conversions"),
        _money("attributed_value_usd").alias("total_revenue_usd"),
        F.round(safe_div(exact_sum(_ratio).cast("double"), F.count(_ratio)), 2).alias("avg_aov"),
        F.countDistinct("channel").alias("channels_used"),
    )


def channel_summary(cross_channel_df: DataFrame) -> DataFrame:
    return cross_channel_df.select(
        "model", "conversion_event", "channel", F.col("attributed_conversions").alias("total_conversions"),
        "total_value_usd", "total_credit", F.col("avg_attributed_value_usd").alias("avg_value_per_credit"),
    ).orderBy("model", "conversion_event", F.col("total_value_usd").desc_nulls_last(), "channel")


def top_paths(path_analysis_df: DataFrame, n: int = 50) -> DataFrame:
    return path_analysis_df.orderBy(F.col("total_conversions").desc(), "path_string").limit(n)


def daily_revenue_by_model(mart: DataFrame) -> DataFrame:
    return mart.groupBy(utc_date("conversion_ts").alias("conversion_date"), "model", "channel").agg(
        _money("attributed_credit").alias("daily_credit"),
        _money("attributed_value_usd").alias("daily_revenue"),
    )


def path_length_revenue(mart: DataFrame, model: str = "last_click") -> DataFrame:
    """Conversions and revenue by path length, from one model's rows (one row
    per conversion for single-touch models)."""
    return mart.where(F.col("model") == model).groupBy("path_length").agg(
        F.count(F.lit(1)).alias("conversions"),
        _money("conversion_value_usd").alias("total_revenue"),
        F.round(safe_div(exact_sum("conversion_value_usd").cast("double"), F.count("conversion_value_usd")), 2)
        .alias("avg_revenue"),
    )


def longest_journeys(journeys_df: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` journeys by path length (ties: conversion id)."""
    return journeys_df.orderBy(F.col("path_length").desc(), "conversion_id").limit(n)


def kpi_totals(mart: DataFrame, model: str | None = None) -> DataFrame:
    """Σcredit, Σvalue USD, Σvalue local and AOV (per model, or one model)."""
    m = mart if model is None else mart.where(F.col("model") == model)
    agg = m.groupBy("model").agg(
        exact_sum("attributed_credit").alias("_c"), exact_sum("attributed_value_usd").alias("_u"),
        exact_sum("attributed_value_local").alias("_l"))
    return agg.select(
        "model", round_to(F.col("_c"), 6).alias("total_conversions"),
        round_to(F.col("_u"), 6).alias("total_revenue_usd"), round_to(F.col("_l"), 6).alias("total_revenue_local"),
        F.round(safe_div(F.col("_u").cast("double"), F.col("_c").cast("double")), 2).alias("aov_usd"),
    )


def aov(mart: DataFrame) -> DataFrame:
    """Average order value per model: sum of attributed value / sum of credit."""
    agg = mart.groupBy("model").agg(exact_sum("attributed_value_usd").alias("_u"),
                                    exact_sum("attributed_credit").alias("_c"))
    return agg.select("model", F.round(safe_div(F.col("_u").cast("double"), F.col("_c").cast("double")), 2)
                      .alias("aov_usd"))


def share_of_conversions(mart: DataFrame) -> DataFrame:
    """channel x model share of all credited conversions."""
    agg = mart.groupBy("channel", "model").agg(exact_sum("attributed_credit").alias("_c"))
    tot = F.sum("_c").over(Window.partitionBy())
    return agg.select("channel", "model", round_to(F.col("_c"), 6).alias("credit"),
                      F.round(safe_div(F.col("_c").cast("double"), tot.cast("double")), 6).alias("share_of_conversions"))


def channel_model_heatmap(mart: DataFrame, metric: str = "revenue", conversion_event: str | None = None) -> DataFrame:
    """Pivot channel x model of revenue, credit or AOV (fixed model columns,
    so the pivot needs no distinct-values pass)."""
    m = mart if conversion_event is None else mart.where(F.col("conversion_event") == conversion_event)
    models = list(RULE_MODELS) + ["data_driven_bqml"]
    g = m.groupBy("channel").pivot("model", models)
    if metric == "revenue":
        out = g.agg(round_to(exact_sum("attributed_value_usd"), 2))
    elif metric == "credit":
        out = g.agg(round_to(exact_sum("attributed_credit"), 4))
    elif metric == "aov":
        out = g.agg(F.round(safe_div(exact_sum("attributed_value_usd").cast("double"),
                                     exact_sum("attributed_credit").cast("double")), 2))
    else:
        raise ValueError("metric must be revenue, credit or aov")
    return out


def path_length_histogram(journeys_df: DataFrame, bucket_from: int | None = None) -> DataFrame:
    """Conversions per path length; with ``bucket_from=10`` lengths >= 10
    fold into one '10+' bucket."""
    if bucket_from:
        b = F.when(F.col("path_length") >= bucket_from, F.lit(f"{bucket_from}+")) \
             .otherwise(F.col("path_length").cast("string"))
    else:
        b = F.col("path_length").cast("string")
    return journeys_df.groupBy(b.alias("path_length_bucket")).agg(F.count(F.lit(1)).alias("conversions"))


def revenue_by_path_length(journeys_df: DataFrame) -> DataFrame:
    return journeys_df.groupBy("path_length").agg(_money("conversion_value_usd", 2).alias("revenue_usd"),
                                                  F.count(F.lit(1)).alias("journeys"))


def device_breakdown(journeys_df: DataFrame) -> DataFrame:
    return journeys_df.groupBy("device_category").agg(F.count(F.lit(1)).alias("journeys"))


def sessions_per_user(traffic_df: DataFrame) -> DataFrame:
    """Σ total_sessions / Σ unique_users over the period (one row)."""
    return traffic_df.agg(
        F.sum("total_sessions").alias("total_sessions"), F.sum("unique_users").alias("unique_users"),
    ).withColumn("sessions_per_user", safe_div(F.col("total_sessions"), F.col("unique_users")))


def traffic_mix(traffic_df: DataFrame) -> DataFrame:
    agg = traffic_df.groupBy("channel").agg(F.sum("total_sessions").alias("sessions"))
    return agg.withColumn("share_of_sessions", F.round(
        safe_div(F.col("sessions"), F.sum("sessions").over(Window.partitionBy())), 6))


def daily_users_by_channel(traffic_df: DataFrame) -> DataFrame:
    """Σ unique_users by date x channel (a user recurring across source /
    medium rows is counted once per row, as the recipe says)."""
    return traffic_df.groupBy("session_date", "channel").agg(
        F.sum("unique_users").alias("unique_users"), F.sum("total_sessions").alias("total_sessions"))


def converting_users(dashboard_df: DataFrame, model: str = "last_click") -> DataFrame:
    return dashboard_df.where(F.col("model") == model).groupBy("channel").agg(
        F.countDistinct("user_pseudo_id").alias("converting_users"))


def conversion_rate_proxy(traffic_df: DataFrame, dashboard_df: DataFrame, model: str = "last_click") -> DataFrame:
    """Converting users (one model) / all users, by channel and date; the
    two sides are aggregated first, then left-joined (approximate by design)."""
    users = traffic_df.groupBy(F.col("session_date").alias("date"), "channel") \
        .agg(F.sum("unique_users").alias("total_users"))
    conv = dashboard_df.where(F.col("model") == model) \
        .groupBy(F.col("conversion_date").alias("date"), "channel") \
        .agg(F.countDistinct("user_pseudo_id").alias("converting_users"))
    j = users.join(conv, ["date", "channel"], "left")
    return j.select("date", "channel", "total_users", "converting_users",
                    F.round(safe_div(F.col("converting_users"), F.col("total_users")), 6).alias("conversion_rate"))


def model_delta_daily(mart: DataFrame, a: str = "first_click", b: str = "last_click") -> DataFrame:
    """Daily revenue of model ``a`` minus model ``b`` (conditional sums, one pass)."""
    d = mart.where(F.col("model").isin(a, b)).groupBy(utc_date("conversion_ts").alias("conversion_date")).agg(
        exact_sum(F.when(F.col("model") == a, F.col("attributed_value_usd")).otherwise(F.lit(0.0))).alias("_a"),
        exact_sum(F.when(F.col("model") == b, F.col("attributed_value_usd")).otherwise(F.lit(0.0))).alias("_b"),
    )
    return d.select("conversion_date", round_to(F.col("_a") - F.col("_b"), 6).alias(f"delta_{a}_vs_{b}"))


def channel_share_per_model(mart: DataFrame) -> DataFrame:
    agg = mart.groupBy("model", "channel").agg(exact_sum("attributed_value_usd").alias("_v"))
    tot = F.sum("_v").over(Window.partitionBy("model"))
    return agg.select("model", "channel", round_to(F.col("_v"), 6).alias("value_usd"),
                      F.round(safe_div(F.col("_v").cast("double"), tot.cast("double")), 6).alias("channel_share"))


def wow_revenue_change(mart: DataFrame, model: str | None = None) -> DataFrame:
    """Daily revenue (per model) vs the same day one week earlier, by a
    self-join on date + 7 days (safe with missing days, unlike lag(7))."""
    m = mart if model is None else mart.where(F.col("model") == model)
    daily = m.groupBy("model", utc_date("conversion_ts").alias("d")).agg(exact_sum("attributed_value_usd").alias("_v"))
    prev = daily.select("model", F.date_add("d", 7).alias("d"), F.col("_v").alias("_p"))
    j = daily.join(prev, ["model", "d"], "left")
    return j.select(
        "model", F.col("d").alias("conversion_date"), round_to(F.col("_v"), 6).alias("revenue_usd"),
        round_to(F.col("_p"), 6).alias("revenue_usd_7d_ago"),
        F.round(safe_div((F.col("_v") - F.col("_p")).cast("double"), F.col("_p").cast("double")), 6)
        .alias("wow_revenue_change"),
    )
