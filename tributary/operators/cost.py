"""Unified cost and the ROAS mart.

Cost tables are small (dates x channels x campaigns) and are pre-aggregated
to the join grain before joining (fan-out guard); joins against them are
left joins of aggregates, which AQE turns into broadcast joins at runtime
when their measured size is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.conversion import value_mode_case
from ..functions.util import exact_sum, round_to, safe_div, utc_date
from ..sources.cost import COST_COLUMNS


def _string_agg_distinct(c: str, sep: str = ", "):
    """STRING_AGG(DISTINCT c, sep ORDER BY c): the set per group is bounded by
    the number of platforms."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def unified_cost(*platforms: DataFrame) -> DataFrame:
    """UNION ALL of platform cost tables (NULL-date guard on every arm) ->
    date x channel x campaign: cost, impressions, clicks, ctr, cpc, sources."""
    arms = [p.select(*COST_COLUMNS).where(F.col("date").isNotNull()) for p in platforms]
    allc = reduce(lambda a, b: a.unionByName(b), arms)
    agg = allc.groupBy("date", "channel", "campaign").agg(
        exact_sum("cost_usd").alias("_cost"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        _string_agg_distinct("source_system").alias("source_systems"),
    )
    return agg.select(
        "date", "channel", "campaign", round_to(F.col("_cost"), 2).alias("cost_usd"), "impressions", "clicks",
        F.round(safe_div(F.col("clicks"), F.col("impressions")), 4).alias("ctr"),
        F.round(safe_div(F.col("_cost").cast("double"), F.col("clicks")), 2).alias("cpc"),
        "source_systems",
    )


def cost_daily(unified: DataFrame) -> DataFrame:
    """Re-aggregate to date x channel; the platform lists are concatenations
    already, so a platform can repeat across campaigns' lists (as upstream)."""
    return unified.groupBy("date", "channel").agg(
        exact_sum("cost_usd").alias("_cost"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        _string_agg_distinct("source_systems").alias("source_systems"),
    )


def attribution_daily(mart: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """date x model x event x value mode x channel totals of the counted mart (a conversion has one date)."""
    return mart.groupBy(
        utc_date("conversion_ts").alias("date"), "model", "conversion_event",
        value_mode_case("conversion_event", cfg).alias("value_mode"), "channel",
    ).agg(
        F.sum("first_of_channel").alias("attributed_conversions"),
        exact_sum("attributed_credit").alias("_credit"),
        exact_sum("attributed_value_usd").alias("_value"),
    )


def roas(daily: DataFrame, unified: DataFrame, data_driven_model: str = "data_driven_bqml") -> DataFrame:
    """date x model x event x channel with cost (purchase rows only), ROAS,
    CPA, RPC, marginal value (data-driven minus last click) and efficiency,
    from the daily totals (``attribution_daily``).

    Last-click and data-driven values come from the same rollup through a
    window over (date, event, channel) instead of two extra scans and joins.
    """
    w = Window.partitionBy("date", "conversion_event", "channel")
    lc = F.max(F.when(F.col("model") == "last_click", F.col("_value"))).over(w)
    dd = F.max(F.when(F.col("model") == data_driven_model, F.col("_value"))).over(w)
    a = daily.select(
        "date", "model", "conversion_event", "value_mode", "channel", "attributed_conversions",
        round_to(F.col("_credit"), 4).alias("total_credit"),
        round_to(F.col("_value"), 2).alias("attributed_value_usd"),
        round_to(dd - lc, 2).alias("marginal_value"),
    )
    c = cost_daily(unified).select("date", "channel", F.col("_cost").cast("double").alias("_cost"),
                                   F.col("impressions").alias("_impr"), F.col("clicks").alias("_clicks"),
                                   F.col("source_systems").alias("_src"))
    j = a.join(c, ["date", "channel"], "left")
    purchase = F.col("conversion_event") == "purchase"
    valued = F.col("value_mode") != "count"
    return j.select(
        "date", "model", "conversion_event", "value_mode", "channel", "attributed_conversions", "total_credit",
        "attributed_value_usd",
        F.when(purchase, F.col("_cost")).alias("cost_usd"),
        F.when(purchase, F.col("_impr")).alias("impressions"),
        F.when(purchase, F.col("_clicks")).alias("clicks"),
        F.when(purchase, F.col("_src")).alias("source_systems"),
        F.when(purchase & valued, F.round(safe_div(F.col("attributed_value_usd"), F.col("_cost")), 2)).alias("roas"),
        F.when(purchase, F.round(safe_div(F.col("_cost"), F.col("attributed_conversions")), 2)).alias("cpa"),
        F.when(valued, F.round(safe_div(F.col("attributed_value_usd"), F.col("attributed_conversions")), 2)).alias("rpc"),
        "marginal_value",
        F.when(purchase & valued, F.round(
            safe_div(F.col("attributed_value_usd"), F.col("_cost"))
            * safe_div(F.col("total_credit"), F.col("attributed_conversions")), 2)).alias("efficiency_score"),
    )
