"""Event export reader and flattener.

``read_events`` scans a date-partitioned export (``event_date=YYYYMMDD``) and
prunes partitions with a literal BETWEEN on the partition column.
``flatten_events`` turns the nested export schema into the flat event shape
used by every operator; source/click-id resolution follows the configured
mode and is validated against ``df.schema`` up front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AttributionConfig
from ..functions.params import event_param
from .fixtures import FLAT_EVENT_COLUMNS, ITEM_TYPE


def read_events(spark: SparkSession, path: str, cfg: AttributionConfig, fmt: str = "parquet") -> DataFrame:
    """Scan ``path`` restricted to ``event_date`` in [scan_start, end_date].

    With ``cfg.widen_scan`` the lower bound is start minus the longest lookback
    (sessions need it); otherwise the stand-alone truncating window.
    """
    df = spark.read.format(fmt).load(path)
    return filter_event_dates(df, cfg)


def filter_event_dates(df: DataFrame, cfg: AttributionConfig) -> DataFrame:
    # event_date is a 'YYYYMMDD' string: lexical BETWEEN equals date order,
    # and literal bounds become PartitionFilters / parquet min-max pushdown.
    return df.where(F.col("event_date").between(F.lit(cfg.scan_start_date), F.lit(cfg.end_date)))


def _has_path(schema: T.StructType, dotted: str) -> bool:
    cur: T.DataType = schema
    for part in dotted.split("."):
        if not isinstance(cur, T.StructType) or part not in cur.fieldNames():
            return False
        cur = cur[part].dataType
    return True


def _field(schema: T.StructType, dotted: str, dtype: str = "string") -> Column:
    """Nested field if present in the schema, else a typed NULL."""
    return F.col(dotted).cast(dtype) if _has_path(schema, dotted) else F.lit(None).cast(dtype)


def _items(schema: T.StructType) -> Column:
    """The items with the fields of ``ITEM_TYPE``, whatever others they have and lack."""
    if "items" not in schema.fieldNames():
        return F.lit(None).cast(ITEM_TYPE)
    if schema["items"].dataType == ITEM_TYPE:
        return F.col("items")
    has = schema["items"].dataType.elementType.fieldNames()
    one = lambda x: F.struct(*[(x[f.name] if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM_TYPE.elementType])
    return F.transform("items", one)


def _require(schema: T.StructType, dotted: str, why: str):
    if not _has_path(schema, dotted):
        raise ValueError(f"column {dotted!r} is required by {why} but is not in the event schema")


def resolve_source(schema: T.StructType, cfg: AttributionConfig, whole: T.StructType | None = None) -> list[Column]:
    """source, medium, campaign, content, term by ``cfg.source_mode``. What the
    mode needs must be in ``whole`` (default: ``schema``); where ``schema`` lacks
    it, it is NULL."""
    mode, whole = cfg.source_mode, whole or schema
    names = ("source", "medium", "campaign", "content", "term")
    stslc = ("source", "medium", "campaign_name", "content", "term")
    collected = ("manual_source", "manual_medium", "manual_campaign_name", "manual_content", "manual_term")
    if mode in ("session_stslc", "auto"):
        _require(whole, "session_traffic_source_last_click.cross_channel_campaign", f"source_mode={mode}")
    if mode in ("collected", "auto"):
        _require(whole, "collected_traffic_source", f"source_mode={mode}")
    out = []
    for n, s, c in zip(names, stslc, collected):
        from_params = event_param(n, "string")
        from_stslc = _field(schema, f"session_traffic_source_last_click.cross_channel_campaign.{s}")
        from_coll = _field(schema, f"collected_traffic_source.{c}")
        expr = {"event_params": from_params, "session_stslc": from_stslc, "collected": from_coll,
                "auto": F.coalesce(from_stslc, from_coll, from_params)}[mode]
        out.append(expr.alias(n))
    return out


def resolve_click_ids(schema: T.StructType, cfg: AttributionConfig) -> list[Column]:
    """gclid, dclid, srsltid by mode; the other five always from params."""
    mode = cfg.source_mode
    out = []
    for n in ("gclid", "dclid", "srsltid"):
        p = event_param(n, "string")
        if mode in ("event_params", "session_stslc"):
            e = p
        elif mode == "collected":
            e = _field(schema, f"collected_traffic_source.{n}")
        else:
            e = F.coalesce(_field(schema, f"collected_traffic_source.{n}"), p)
        out.append(e.alias(n))
    out += [event_param(n, "string").alias(n) for n in ("msclkid", "fbclid", "ttclid", "twclid", "li_fat_id")]
    return out


def privacy_passthrough(schema: T.StructType, cfg: AttributionConfig, whole: T.StructType | None = None) -> list[Column]:
    names = ("analytics_storage", "ads_storage", "uses_transient_token")
    if cfg.has_privacy_info:
        _require(whole or schema, "privacy_info", "has_privacy_info=True")
        return [_field(schema, f"privacy_info.{n}").alias(f"privacy_{n}") for n in names]
    return [F.lit(None).cast("string").alias(f"privacy_{n}") for n in names]


def modeled_events_filter(df: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Drop consent-modelled events of a flat table when ``exclude_modeled_events``."""
    if not cfg.exclude_modeled_events:
        return df
    return df.where(F.coalesce(F.col("privacy_uses_transient_token"), F.lit("No")) != "Yes")


def modeled_raw_filter(df: DataFrame, cfg: AttributionConfig, whole: T.StructType | None = None) -> DataFrame:
    """The same on the nested export. It reads the raw field whether or not
    the privacy columns are carried along, and needs it to be there."""
    if not cfg.exclude_modeled_events:
        return df
    _require(whole or df.schema, "privacy_info.uses_transient_token", "exclude_modeled_events=True")
    return df.where(F.coalesce(_field(df.schema, "privacy_info.uses_transient_token"), F.lit("No")) != "Yes")


def flatten_events(df: DataFrame, cfg: AttributionConfig, whole: T.StructType | None = None) -> DataFrame:
    """Nested export -> flat events (one row per event, same grain). ``whole``
    is the schema of the export that ``df`` is a part of (see ``shards``)."""
    sch = df.schema
    df = modeled_raw_filter(df, cfg, whole)
    eco = lambda f, t: _field(sch, f"ecommerce.{f}", t)
    cols = [
        F.col("event_date").cast("string").alias("event_date"),
        F.col("event_timestamp").cast("bigint").alias("event_timestamp"),
        F.col("event_name"),
        F.col("user_pseudo_id").cast("string").alias("user_pseudo_id"),
        _field(sch, "platform").alias("platform"),
        event_param("ga_session_id", "int").alias("session_id"),
        *resolve_source(sch, cfg, whole),
        *resolve_click_ids(sch, cfg),
        event_param("page_location").alias("page_location"),
        event_param("page_referrer").alias("page_referrer"),
        event_param("hostname").alias("hostname"),
        _field(sch, "traffic_source.name").alias("user_first_touch_campaign"),
        _field(sch, "device.category").alias("device_category"),
        _field(sch, "device.operating_system").alias("device_os"),
        _field(sch, "device.language").alias("device_language"),
        _field(sch, "device.web_info.browser").alias("browser"),
        _field(sch, "device.web_info.browser_version").alias("browser_version"),
        _field(sch, "geo.country").alias("country"),
        _field(sch, "geo.region").alias("region"),
        _field(sch, "geo.city").alias("city"),
        *privacy_passthrough(sch, cfg, whole),
        eco("transaction_id", "string").alias("transaction_id"),
        eco("purchase_revenue", "double").alias("purchase_revenue"),
        eco("purchase_revenue_in_usd", "double").alias("purchase_revenue_in_usd"),
        eco("total_item_quantity", "bigint").alias("total_item_quantity"),
        eco("shipping_value", "double").alias("shipping_value"),
        eco("tax_value", "double").alias("tax_value"),
        eco("refund_value", "double").alias("refund_value"),
        eco("unique_items", "bigint").alias("unique_items"),
        _items(sch).alias("items"),
        event_param("value", "float").alias("event_value"),
        event_param("currency", "string").alias("event_currency"),
        event_param("quantity", "int").alias("event_quantity"),
        *[_field(sch, f"session_traffic_source_last_click.cross_channel_campaign.{f}").alias(f"last_click_{n}")
          for n, f in (("source", "source"), ("medium", "medium"), ("campaign", "campaign_name"))],
    ]
    return df.select(*cols).select(*FLAT_EVENT_COLUMNS)
