"""Lookback join of conversions to prior sessions, ordered journeys, path rows.

Plan shape (pipeline semantics):

1. Conversion *keys* only (4 key columns + event) meet sessions in time buckets
   as wide as the longest lookback window, so a conversion has at most two
   copies. The join is an equi-join on ``(user_pseudo_id, bucket)`` with the
   exact range test as a residual; a heavy user's bucket is split at run time
   by the adaptive skew join.
2. The matched touchpoints are aggregated per conversion into the ordered
   ``path`` array (``array_sort(collect_list(struct))``, partial aggregate).
   Only the session fields that the caller names go through the join.
3. The conversion payload is joined back on the NULL-free conversion key;
   the aggregate output is already hash-partitioned on that key, and the
   conversions' own exchange is reused, so events are scanned twice in all.
4. ``user_conversion_seq`` numbers a user's conversions exactly, per
   (user, minute) plus the counts of the user's earlier minutes, so no task
   holds all of one user's conversions, or all of one day's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MICROS_PER_DAY, STANDALONE_LOOKBACK_DAYS, AttributionConfig
from ..functions.conversion import lookback_case
from ..functions.util import whole_hours
from ..plans.joins import explode_buckets, row_number_within
from .conversions import CONVERSION_PAYLOAD

# --- fixed values: struct fields of one path element. session_start leads (then
# session_id), so that sorting the array orders by time with a deterministic
# tie-break. ---
PATH_FIELDS = (
    "session_start", "session_id", "source", "medium", "campaign", "content", "term", "channel",
    "gclid", "dclid", "srsltid", "msclkid", "fbclid", "ttclid", "twclid", "li_fat_id",
    "page_location", "page_referrer", "hostname", "user_first_touch_campaign", "browser", "browser_version",
    "privacy_analytics_storage", "privacy_ads_storage", "privacy_uses_transient_token",
    "hours_before_conversion",
)
# The fields that models, reports and the training set read.
MODEL_FIELDS = ("session_start", "session_id", "source", "medium", "campaign", "channel", "hours_before_conversion")
CONV_KEY = ("user_pseudo_id", "conversion_us", "conversion_event", "conversion_key")

JOURNEY_COLUMNS = (
    "user_pseudo_id", "conversion_ts", "conversion_event", "event_date", "platform", "transaction_id",
    "conversion_value_local", "conversion_value_usd", *CONVERSION_PAYLOAD, "conversion_session_id",
    "path", "path_length", "user_conversion_seq", "conversion_id", "conversion_us", "conversion_key",
)


def lookback_lower_bound(conv_us, lookback_days, cfg: AttributionConfig):
    """Smallest session time (inclusive, micros) inside the lookback window.

    whole_days: TIMESTAMP_DIFF(c, s, DAY) <= L  <=>  s > c - (L+1) days.
    exact:      s >= c - L days.
    """
    if cfg.lookback_mode == "exact":
        return conv_us - lookback_days * F.lit(MICROS_PER_DAY)
    return conv_us - (lookback_days + 1) * F.lit(MICROS_PER_DAY) + 1


def touchpoints(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig,
                session_fields=PATH_FIELDS, lookback=None, carry=()) -> DataFrame:
    """All (conversion key, session) pairs with the session inside the
    conversion's lookback window, as flat rows.

    ``lookback``: Column of days per conversion (default: per-event config).
    ``carry``: more columns of the conversions to take along.
    """
    bucket_us = cfg.join_bucket_micros
    lb = lookback if lookback is not None else lookback_case(F.col("conversion_event"), cfg)
    c = conversions.select(*CONV_KEY, *carry, lb.cast("long").alias("_lb"))
    # never null (conversion times are not): stated, so that no null test on it is
    # pushed below the conversions' aggregate
    c = c.withColumn("_lo", F.coalesce(lookback_lower_bound(F.col("conversion_us"), F.col("_lb"), cfg), F.lit(0)))
    c = c.select(*CONV_KEY, *carry, "_lo", explode_buckets(F.col("_lo"), F.col("conversion_us"), bucket_us))
    wanted = [f for f in session_fields if f not in ("hours_before_conversion",)]
    s = sessions.select(
        F.col("user_pseudo_id").alias("_su"), "session_start_us",
        *[F.col(f) for f in wanted if f != "session_start_us"],
        F.floor(F.col("session_start_us") / F.lit(bucket_us)).cast("long").alias("_sb"),
    )
    j = c.join(
        s,
        (F.col("user_pseudo_id") == F.col("_su")) & (F.col("_bucket") == F.col("_sb"))
        & F.col("session_start_us").between(F.col("_lo"), F.col("conversion_us")),
        "inner",
    )
    return j.withColumn("hours_before_conversion", whole_hours(F.col("conversion_us"), F.col("session_start_us"))) \
            .drop("_su", "_sb", "_bucket", "_lo")


def matched(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig, fields=PATH_FIELDS) -> DataFrame:
    """One row per conversion that has at least one session in its window,
    with the ordered ``path`` (structs of ``fields``) and ``path_length``."""
    # stated for both reads of the conversions, which the joins would otherwise
    # give different filters (and so exchanges of their own)
    conversions = conversions.where(reduce(and_, [F.col(k).isNotNull() for k in CONV_KEY]))
    tp = touchpoints(sessions, conversions, cfg, fields)
    paths = tp.groupBy(*CONV_KEY).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(f) for f in fields]))).alias("path"),
        F.count(F.lit(1)).alias("path_length"),
    )
    return paths.join(conversions, on=list(CONV_KEY), how="inner")


def numbered(matched_df: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Journeys with ``user_conversion_seq`` and ``conversion_id = user-seq``.
    ``matched_df`` is read twice (numbers and bucket counts)."""
    j = row_number_within(
        matched_df, "user_pseudo_id", F.floor(F.col("conversion_us") / F.lit(cfg.number_bucket_micros)),
        ["conversion_us", "conversion_event", F.coalesce(F.col("transaction_id"), F.lit(""))],
        "user_conversion_seq")
    return j.select(
        "user_pseudo_id", "conversion_ts", "conversion_event", "event_date", "platform", "transaction_id",
        F.col("purchase_revenue").alias("conversion_value_local"),
        F.col("purchase_revenue_in_usd").alias("conversion_value_usd"),
        *CONVERSION_PAYLOAD, "conversion_session_id", "path", "path_length", "user_conversion_seq",
        F.concat(F.col("user_pseudo_id"), F.lit("-"), F.col("user_conversion_seq").cast("string")).alias("conversion_id"),
        "conversion_us", "conversion_key",
    )


def journeys(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig, fields=PATH_FIELDS,
             store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """:func:`matched`, then :func:`numbered`. ``store`` writes the matched
    journeys to shared storage and reads them back; without it the lookback
    join is planned once for each of the numbering's two reads."""
    m = matched(sessions, conversions, cfg, fields)
    return numbered(store(m) if store else m, cfg)


PATH_ROW_JOURNEY_COLUMNS = (
    "user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "event_date", "platform",
    "transaction_id", "conversion_value_local", "conversion_value_usd", "total_item_quantity",
    "shipping_value", "tax_value", "refund_value", "unique_items", "items", "event_value",
    "event_currency", "event_quantity", "device_category", "device_os", "device_language",
    "country", "region", "city", "conversion_session_id", "path_length",
)


def path_rows(journeys_df: DataFrame) -> DataFrame:
    """Unnest the path: one row per touchpoint with ascending and descending
    positions taken from the array index (no window, no shuffle)."""
    exploded = journeys_df.select(*PATH_ROW_JOURNEY_COLUMNS, F.posexplode("path").alias("_pos", "tp"))
    return exploded.select(
        *PATH_ROW_JOURNEY_COLUMNS,
        *[F.col(f"tp.{f}").alias(f) for f in PATH_FIELDS],
        (F.col("_pos") + 1).cast("bigint").alias("session_position_asc"),
        (F.col("path_length") - F.col("_pos")).cast("bigint").alias("session_position_desc"),
    )


# ---- stand-alone variant ------------------------------------------------------

STANDALONE_PATH_FIELDS = ("session_start", "session_id", "source", "medium", "campaign", "channel")


def journeys_exact30(sessions_sa: DataFrame, conversions_sa: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Stand-alone purchase journeys: sessions with c - 30 days <= s <= c,
    inner join, ordered path of (session_start, source, medium, campaign,
    channel), one row per numbered purchase."""
    cfg_exact = cfg.with_(lookback_mode="exact")
    conv = conversions_sa.select(
        "user_pseudo_id", "conversion_us", F.lit("purchase").alias("conversion_event"),
        F.col("conversion_id").cast("string").alias("conversion_key"))
    tp = touchpoints(sessions_sa, conv, cfg_exact,
                     session_fields=("session_start", "session_id", "source", "medium", "campaign", "channel"),
                     lookback=F.lit(STANDALONE_LOOKBACK_DAYS))
    paths = tp.groupBy("user_pseudo_id", "conversion_us", "conversion_key").agg(
        F.array_sort(F.collect_list(F.struct(
            "session_start", "session_id", "source", "medium", "campaign", "channel",
            "hours_before_conversion", "session_start_us"))).alias("path"),
        F.count(F.lit(1)).alias("path_length"),
    )
    c = conversions_sa.select(
        "user_pseudo_id", "conversion_us", F.col("conversion_id").cast("string").alias("conversion_key"),
        "conversion_ts", "conversion_id", "conversion_revenue", "transaction_id")
    return paths.join(c, on=["user_pseudo_id", "conversion_us", "conversion_key"], how="inner").select(
        "user_pseudo_id", "conversion_ts", "conversion_id", "conversion_revenue", "transaction_id",
        "path", "path_length", "conversion_us")


def path_rows_standalone(journeys_sa: DataFrame) -> DataFrame:
    e = journeys_sa.select("user_pseudo_id", "conversion_ts", "conversion_id", "path_length",
                           F.posexplode("path").alias("_pos", "tp"))
    return e.select(
        "user_pseudo_id", "conversion_ts", "conversion_id", "path_length",
        F.col("tp.session_start").alias("session_start"), F.col("tp.source").alias("source"),
        F.col("tp.medium").alias("medium"), F.col("tp.campaign").alias("campaign"),
        F.col("tp.channel").alias("channel"),
        (F.col("_pos") + 1).cast("bigint").alias("session_position"),
        (F.col("path_length") - F.col("_pos")).cast("bigint").alias("session_position_desc"),
        F.col("tp.hours_before_conversion").alias("hours_before_conversion"),
    )
