"""Sessionisation: one row per (user_pseudo_id, session_id).

The first event of a session is chosen with one hash-partitioned aggregate
(``min`` over a struct led by the event time), so map-side partial
aggregation collapses a hot session to one row per input partition before
the shuffle; no window over raw events is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.channels import channel_grouping_8, channel_grouping_19
from ..sources.events import modeled_events_filter

# fixed values: carried from the picked event, in output order
SESSION_PAYLOAD = (
    "gclid", "dclid", "srsltid", "msclkid", "fbclid", "ttclid", "twclid", "li_fat_id",
    "page_location", "page_referrer", "hostname", "user_first_touch_campaign",
    "device_category", "device_os", "device_language", "browser", "browser_version",
    "country", "region", "city",
    "privacy_analytics_storage", "privacy_ads_storage", "privacy_uses_transient_token",
)
SESSION_COLUMNS = (
    "user_pseudo_id", "session_id", "session_start", "source", "medium", "campaign", "content", "term",
    "channel", *SESSION_PAYLOAD, "session_start_us",
)
AUTO_EVENTS = ("session_start", "first_visit")


def session_events(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Events eligible for sessions: session id present, time in
    [start - max lookback, end bound]."""
    ev = events.where(F.col("session_id").isNotNull())
    ev = ev.where(F.col("event_timestamp").between(F.lit(cfg.session_start_micros), F.lit(cfg.end_micros)))
    return modeled_events_filter(ev, cfg)


def sessions(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Deduplicated sessions with traffic defaults and the 19-way channel."""
    ev = session_events(events, cfg)
    first = F.min(F.struct(
        F.col("event_timestamp").alias("ts"),
        F.col("event_name").alias("event_name"),
        F.coalesce("source", F.lit("(direct)")).alias("source"),
        F.coalesce("medium", F.lit("(none)")).alias("medium"),
        F.coalesce("campaign", F.lit("")).alias("campaign"),
        F.coalesce("content", F.lit("")).alias("content"),
        F.coalesce("term", F.lit("")).alias("term"),
        *[F.col(c) for c in SESSION_PAYLOAD],
    )).alias("f")
    agg = ev.groupBy("user_pseudo_id", "session_id").agg(first)
    return agg.select(
        "user_pseudo_id", "session_id",
        F.timestamp_micros(F.col("f.ts")).alias("session_start"),
        *[F.col(f"f.{c}").alias(c) for c in ("source", "medium", "campaign", "content", "term")],
        channel_grouping_19(F.col("f.medium"), F.col("f.source"), F.col("f.campaign"), cfg.brand_regex).alias("channel"),
        *[F.col(f"f.{c}").alias(c) for c in SESSION_PAYLOAD],
        F.col("f.ts").alias("session_start_us"),
    )


def sessions_first_non_auto(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Stand-alone rule: per session pick the earliest non-auto event carrying
    source or medium; else a ``session_start`` carrying them; else the earliest
    event. ``session_start`` is the picked event's time. 8-way channel.
    ``events`` is the scan by ``event_date``: these scripts have no other time
    filter, so a property's own days count whatever its time zone.
    """
    ev = events.where(F.col("session_id").isNotNull())
    has_traffic = F.col("source").isNotNull() | F.col("medium").isNotNull()
    p1 = F.when(~F.col("event_name").isin(*AUTO_EVENTS) & has_traffic, 0).otherwise(1)
    p2 = F.when((F.col("event_name") == "session_start") & has_traffic, 0).otherwise(1)
    pick = F.min(F.struct(
        p1.alias("p1"), p2.alias("p2"), F.col("event_timestamp").alias("ts"),
        F.col("event_name").alias("event_name"),
        F.col("source").alias("source"), F.col("medium").alias("medium"), F.col("campaign").alias("campaign"),
    )).alias("f")
    agg = ev.groupBy("user_pseudo_id", "session_id").agg(pick)
    return agg.select(
        "user_pseudo_id", "session_id",
        F.timestamp_micros(F.col("f.ts")).alias("session_start"),
        F.coalesce(F.col("f.source"), F.lit("(direct)")).alias("source"),
        F.coalesce(F.col("f.medium"), F.lit("(none)")).alias("medium"),
        F.col("f.campaign").alias("campaign"),
        channel_grouping_8(F.col("f.medium"), F.col("f.source")).alias("channel"),
        F.col("f.ts").alias("session_start_us"),
    )

