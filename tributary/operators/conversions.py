"""Conversion extraction and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..sources.events import modeled_events_filter

# fixed values: the payload columns, in output order
CONVERSION_PAYLOAD = (
    "total_item_quantity", "shipping_value", "tax_value", "refund_value", "unique_items", "items",
    "event_value", "event_currency", "event_quantity",
    "device_category", "device_os", "device_language", "country", "region", "city",
)
CONVERSION_COLUMNS = (
    "user_pseudo_id", "conversion_ts", "conversion_event", "event_date", "platform", "transaction_id",
    "purchase_revenue", "purchase_revenue_in_usd", *CONVERSION_PAYLOAD, "conversion_session_id",
    "conversion_us", "conversion_key",
)


def conversion_events(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Configured events in [start, end bound]. ``event_name IN`` and the
    time bounds push down to the parquet scan."""
    ev = events.where(F.col("event_name").isin(*cfg.event_names))
    ev = ev.where(F.col("event_timestamp").between(F.lit(cfg.start_micros), F.lit(cfg.end_micros)))
    return modeled_events_filter(ev, cfg)


def conversions(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """One row per (user, time, event, COALESCE(transaction_id, time)),
    keeping the highest local then USD revenue (NULLs lose).

    ``conversion_key`` is that non-NULL dedup key's transaction part; it makes
    (user_pseudo_id, conversion_us, conversion_event, conversion_key) a
    NULL-free equi-join key for later stages. Dedup is a ``max`` over a struct
    led by the revenues, so it is a partial (map-side) aggregate.
    """
    ev = conversion_events(events, cfg)
    key = F.coalesce(F.col("transaction_id"), F.col("event_timestamp").cast("string"))
    best = F.max(F.struct(
        F.col("purchase_revenue"), F.col("purchase_revenue_in_usd"),
        F.col("transaction_id"), F.col("event_date"), F.col("platform"),
        *[F.col(c) for c in CONVERSION_PAYLOAD],
        F.col("session_id").alias("conversion_session_id"),
    )).alias("b")
    agg = ev.groupBy("user_pseudo_id", F.col("event_timestamp").alias("conversion_us"),
                     F.col("event_name").alias("conversion_event"), key.alias("conversion_key")).agg(best)
    # always true; it keeps the payload in plans that read the keys alone, so
    # that both reads of the journeys share one exchange and one scan
    agg = agg.where(F.col("b").isNotNull())
    return agg.select(
        "user_pseudo_id",
        F.timestamp_micros(F.col("conversion_us")).alias("conversion_ts"),
        "conversion_event",
        F.col("b.event_date").alias("event_date"),
        F.col("b.platform").alias("platform"),
        F.col("b.transaction_id").alias("transaction_id"),
        F.col("b.purchase_revenue").alias("purchase_revenue"),
        F.col("b.purchase_revenue_in_usd").alias("purchase_revenue_in_usd"),
        *[F.col(f"b.{c}").alias(c) for c in CONVERSION_PAYLOAD],
        F.col("b.conversion_session_id").alias("conversion_session_id"),
        "conversion_us", "conversion_key",
    )


def conversions_purchase(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Stand-alone: every purchase event of the scan, no dedup, numbered per
    user by time (ties by transaction id)."""
    from ..plans.joins import row_number_within

    ev = events.where(F.col("event_name") == "purchase").select(
        "user_pseudo_id", "event_timestamp", "purchase_revenue", "transaction_id")
    ev = row_number_within(
        ev, "user_pseudo_id", F.floor(F.col("event_timestamp") / F.lit(cfg.number_bucket_micros)),
        ["event_timestamp", F.col("transaction_id").asc_nulls_first(), F.col("purchase_revenue").asc_nulls_first()],
        "conversion_id")
    return ev.select(
        "user_pseudo_id",
        F.timestamp_micros("event_timestamp").alias("conversion_ts"),
        "conversion_id",
        F.col("purchase_revenue").alias("conversion_revenue"),
        "transaction_id",
        F.col("event_timestamp").alias("conversion_us"),
    )
