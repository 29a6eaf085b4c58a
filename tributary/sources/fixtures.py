"""Deterministic mapping of the driver's ``events`` table onto the analytics
event schema (FIXTURES.md §2), as one narrow projection.

The flat form (:func:`fixture_events`) has exactly the columns that
:func:`tributary.sources.events.flatten_events` produces from a nested export,
so every operator runs on either. :func:`fixture_events_nested` builds the
nested export shape from the same rows, to exercise the readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MICROS_PER_DAY

# --- fixed values (fixture traffic lookup, FIXTURES.md §3, rows 0..25) ---------
TRAFFIC_ROWS = (
    (None, None, None),
    ("google", "cpc", "yourbrand_search"),
    ("google", "cpc", "generic_search"),
    ("google", "cpc", "pmax_all"),
    ("google", "cpc", "shopping_feed"),
    ("youtube", "cpv", "video_a"),
    ("facebook", "paidsocial", "spring"),
    ("dv360", "display", "banner_a"),
    ("shopping.example", "referral", None),
    ("vimeo", "referral", None),
    ("instagram", "referral", None),
    ("google", "organic", None),
    ("news", "email", "weekly"),
    ("crm", "sms", "promo"),
    ("partner", "affiliate", None),
    ("spotify", "podcast", None),
    ("app", "push", None),
    ("blog.example", "referral", None),
    ("<Other>", "<Other>", "<Other>"),
    ("facebook", "cpc", "prospecting"),
    ("<Other>", None, None),
    ("youtube", "cpm", "bumper"),
    ("google", "CPC", "upper"),
    ("x", "social", None),
    ("google", "cpc", "Performance Max - UK"),
    ("google", "cpc", "Demand Gen Q1"),
)
# event_type -> event_name; 'error' splits three ways on k % 3.
EVENT_NAME_MAP = (
    ("view", "view_item"),
    ("click", "add_to_cart"),
    ("signup", "begin_checkout"),
    ("purchase", "purchase"),
)
ERROR_EVENT_NAMES = ("add_shipping_info", "add_payment_info", "session_start")
# Users with user_id % 7 = 3 never convert: their events are views and session starts.
BROWSER_MODULUS, BROWSER_REMAINDER = 7, 3
# The property's days start at 05:00 UTC, so event_date differs from the UTC day.
PROPERTY_OFFSET_HOURS = 5
DEVICE_CATEGORIES = ("desktop", "mobile", "tablet")
# Click ids of the nested fixture: present where k is a multiple of n.
CLICK_IDS = (("gclid", 6), ("dclid", 10), ("srsltid", 14), ("msclkid", 15), ("fbclid", 21), ("ttclid", 22),
             ("twclid", 26), ("li_fat_id", 33))
# More text of the nested fixture: <prefix>-<k % m>; and numbers: k * unit, where k is no multiple of m.
NESTED_TEXT = (("content", "ct", 4), ("term", "tm", 7), ("hostname", "h", 5), ("page_referrer", "ref", 9), ("user_first_touch_campaign", "ft", 11),
               ("device_os", "os", 4), ("device_language", "l", 6), ("browser", "b", 3), ("browser_version", "v", 10), ("region", "r", 8), ("city", "c", 12))
NESTED_NUMBERS = (("total_item_quantity", 1, 6), ("shipping_value", 0.25, 5), ("tax_value", 0.5, 8), ("refund_value", 0.125, 2), ("unique_items", 2, 7),
                  ("event_quantity", 3, 4))
FIXTURE_PLATFORM = "WEB"
FIXTURE_CURRENCY = "USD"
# ------------------------------------------------------------------------------

ITEM_TYPE = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DoubleType()),
]))

# Flat event columns (the staging input shape), with their types.
FLAT_EVENT_SCHEMA = [
    ("event_date", "string"), ("event_timestamp", "bigint"), ("event_name", "string"),
    ("user_pseudo_id", "string"), ("platform", "string"), ("session_id", "bigint"),
    ("source", "string"), ("medium", "string"), ("campaign", "string"), ("content", "string"),
    ("term", "string"), ("gclid", "string"), ("dclid", "string"), ("srsltid", "string"),
    ("msclkid", "string"), ("fbclid", "string"), ("ttclid", "string"), ("twclid", "string"),
    ("li_fat_id", "string"), ("page_location", "string"), ("page_referrer", "string"),
    ("hostname", "string"), ("user_first_touch_campaign", "string"),
    ("device_category", "string"), ("device_os", "string"), ("device_language", "string"),
    ("browser", "string"), ("browser_version", "string"),
    ("country", "string"), ("region", "string"), ("city", "string"),
    ("privacy_analytics_storage", "string"), ("privacy_ads_storage", "string"),
    ("privacy_uses_transient_token", "string"),
    ("transaction_id", "string"), ("purchase_revenue", "double"), ("purchase_revenue_in_usd", "double"),
    ("total_item_quantity", "bigint"), ("shipping_value", "double"), ("tax_value", "double"),
    ("refund_value", "double"), ("unique_items", "bigint"), ("items", ITEM_TYPE.simpleString()),
    ("event_value", "double"), ("event_currency", "string"), ("event_quantity", "bigint"),
    ("last_click_source", "string"), ("last_click_medium", "string"), ("last_click_campaign", "string"),
]
FLAT_EVENT_COLUMNS = [c for c, _ in FLAT_EVENT_SCHEMA]


def _lookup(values, idx: Column) -> Column:
    """values[idx] (0-based) for a short literal list, evaluated in-row (the
    list goes to the planner as one expression, not one call per value)."""
    items = ", ".join("CAST(NULL AS STRING)" if v is None else "'" + str(v).replace("'", "\\'") + "'" for v in values)
    return F.element_at(F.expr(f"array({items})"), (idx + 1).cast("int"))


def _epoch_micros(ts_col: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_col})")
    return F.unix_micros(F.col(ts_col))


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``events`` (+ ``nation``) -> flat analytics events."""
    return fixture_base(spark, sf_dir).select(*FLAT_EVENT_COLUMNS)


def fixture_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events plus the (copy-adjusted) raw ``_value`` of every event."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").cast("long").alias("_nk"), F.col("n_name").alias("country"))

    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    us = _epoch_micros("ts", ev.schema["ts"].dataType)
    # events with event_id % 50 = 0 appear twice; the copy carries value - 1.
    # The parsed property k is emitted by the same generator, so predicates on
    # anything derived from it (event name, traffic, channel) stay above the
    # Generate and run once per row in the parallel stage, instead of being
    # pushed into the scan with the JSON parse inlined at every reference.
    one = lambda c: F.struct(F.lit(c).alias("_copy"), k.alias("_k"))
    pairs = F.when(F.col("event_id") % 50 == 0, F.array(one(0), one(1))).otherwise(F.array(one(0)))
    base = ev.select(
        "event_id", "user_id", "event_type", "value", "ts",
        us.alias("event_timestamp"), F.inline(pairs),
    )
    value = F.when((F.col("_copy") == 1) & (F.col("value") >= 1), F.col("value") - 1).otherwise(F.col("value"))
    browser = F.col("user_id") % BROWSER_MODULUS == BROWSER_REMAINDER
    is_purchase = (F.col("event_type") == "purchase") & ~browser
    t = F.col("_k") % len(TRAFFIC_ROWS)
    name = None
    for et, en in EVENT_NAME_MAP:
        name = F.when(F.col("event_type") == et, en) if name is None else name.when(F.col("event_type") == et, en)
    name = name.when(F.col("event_type") == "error", _lookup(ERROR_EVENT_NAMES, F.col("_k") % 3))
    name = F.when(browser, F.when(F.col("event_type") == "error", "session_start").otherwise("view_item")).otherwise(name)
    # the last-click struct: the next row of the lookup, absent for every fourth k
    lc = F.when(F.col("_k") % 4 != 0, (F.col("_k") + 1) % len(TRAFFIC_ROWS))

    s = lambda dtype: F.expr(f"CAST(NULL AS {dtype})")
    flat = base.select(
        F.date_format(F.col("ts") - F.expr(f"INTERVAL {PROPERTY_OFFSET_HOURS} HOURS"), "yyyyMMdd").alias("event_date"),
        F.col("event_timestamp"),
        name.alias("event_name"),
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        F.lit(FIXTURE_PLATFORM).alias("platform"),
        F.when(F.col("event_id") % 10 < 4, F.floor(F.col("event_timestamp") / F.lit(MICROS_PER_DAY)))
         .cast("bigint").alias("session_id"),
        _lookup([r[0] for r in TRAFFIC_ROWS], t).alias("source"),
        _lookup([r[1] for r in TRAFFIC_ROWS], t).alias("medium"),
        _lookup([r[2] for r in TRAFFIC_ROWS], t).alias("campaign"),
        s("string").alias("content"), s("string").alias("term"),
        *[s("string").alias(c) for c in ("gclid", "dclid", "srsltid", "msclkid", "fbclid", "ttclid",
                                          "twclid", "li_fat_id", "page_location", "page_referrer",
                                          "hostname", "user_first_touch_campaign")],
        _lookup(DEVICE_CATEGORIES, F.col("user_id") % 3).alias("device_category"),
        *[s("string").alias(c) for c in ("device_os", "device_language", "browser", "browser_version")],
        (F.col("user_id") % 25).alias("_nk"),
        s("string").alias("region"), s("string").alias("city"),
        *[s("string").alias(c) for c in ("privacy_analytics_storage", "privacy_ads_storage",
                                          "privacy_uses_transient_token")],
        F.when(is_purchase & (F.col("_k") % 10 != 0), F.concat(F.lit("T"), F.col("event_id").cast("string")))
         .alias("transaction_id"),
        # local revenue = 0.9 x USD, in exact decimal arithmetic, to cents
        F.when(is_purchase, F.round(value.cast("decimal(18,2)") * F.lit(0.9).cast("decimal(2,1)"), 2)
               .cast("double")).alias("purchase_revenue"),
        F.when(is_purchase, value).alias("purchase_revenue_in_usd"),
        s("bigint").alias("total_item_quantity"),
        s("double").alias("shipping_value"), s("double").alias("tax_value"), s("double").alias("refund_value"),
        s("bigint").alias("unique_items"),
        F.lit(None).cast(ITEM_TYPE).alias("items"),
        F.when(is_purchase, value).alias("event_value"),
        F.when(is_purchase, F.lit(FIXTURE_CURRENCY)).alias("event_currency"),
        s("bigint").alias("event_quantity"),
        *[_lookup([r[i] for r in TRAFFIC_ROWS], lc).alias(f"last_click_{n}")
          for i, n in enumerate(("source", "medium", "campaign"))],
        F.col("_k").alias("_k"),
        value.alias("_value"),
    )
    # a 25-row dimension: Spark broadcasts it by its file size
    out = flat.join(nation, on="_nk", how="left")
    return out.select(*FLAT_EVENT_COLUMNS, "_value", "_k")


def fixture_events_nested(spark: SparkSession, sf_dir: str, modern: bool = True) -> DataFrame:
    """The same rows in the nested export schema (FIXTURES.md §1).

    ``modern=True`` adds the optional ``session_traffic_source_last_click``,
    ``collected_traffic_source`` and ``privacy_info`` structs. The traffic
    structs hold other rows of the lookup than the params (the next one, the
    one after it), so the source modes resolve differently; click ids, page
    context and consent are derived from k (FIXTURES.md §1).
    """
    base = fixture_base(spark, sf_dir)
    k = F.col("_k")
    text = lambda name, n: F.when(k % n == 0, F.concat(F.lit(f"{name}-"), k.cast("string")))
    flat = base.withColumns({c: text(c, n) for c, n in CLICK_IDS} | {
        "page_location": F.concat(F.lit("https://shop.example/p/"), k.cast("string")),
        "privacy_analytics_storage": F.when(k % 3 == 0, "Yes").otherwise("No"),
        "privacy_ads_storage": F.when(k % 5 == 0, "Yes"),
        "privacy_uses_transient_token": F.when(k % 10 == 9, "Yes").when(k % 10 == 8, "No")}
        | {c: F.concat(F.lit(f"{x}-"), (k % m).cast("string")) for c, x, m in NESTED_TEXT}
        | {c: F.when(k % m != 0, k * F.lit(unit)) for c, unit, m in NESTED_NUMBERS})
    item = lambda i: F.struct(F.concat(F.lit(f"i{i}-"), k.cast("string")).alias("item_id"), F.concat(F.lit("n-"), k.cast("string")).alias("item_name"),
                              (k + i).cast("long").alias("quantity"), (k * F.lit(1.25)).alias("price"))
    flat = flat.withColumn("items", F.when(k % 4 == 1, F.array(item(1), item(2))).when(k % 4 == 2, F.array(item(1))))
    told = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    collected = F.when(k % 5 != 0, (k + 2) % len(TRAFFIC_ROWS))
    coll = [_lookup([r[i] for r in TRAFFIC_ROWS], collected) for i in range(3)]

    def param(key, kind, c):
        return F.struct(F.lit(key).alias("key"), F.struct(
            (c if kind == "string" else F.lit(None).cast("string")).alias("string_value"),
            (c.cast("long") if kind == "int" else F.lit(None).cast("long")).alias("int_value"),
            (c.cast("double") if kind == "float" else F.lit(None).cast("double")).alias("float_value"),
            F.lit(None).cast("double").alias("double_value"),
        ).alias("value"))

    params = [param("ga_session_id", "int", F.col("session_id"))]
    params += [param(c, "string", F.col(c)) for c in (
        "source", "medium", "campaign", "content", "term", "gclid", "dclid", "srsltid", "msclkid",
        "fbclid", "ttclid", "twclid", "li_fat_id", "page_location", "page_referrer", "hostname",
        "event_currency")]
    params[-1] = param("currency", "string", F.col("event_currency"))
    params += [param("value", "float", F.col("event_value")), param("quantity", "int", F.col("event_quantity"))]
    present = F.filter(F.array(*params), lambda p: p["value"]["string_value"].isNotNull()
                       | p["value"]["int_value"].isNotNull() | p["value"]["float_value"].isNotNull())
    cols = [
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "platform",
        present.alias("event_params"),
        F.struct("transaction_id", "purchase_revenue", "purchase_revenue_in_usd", F.col("total_item_quantity").cast("long").alias("total_item_quantity"),
                 *[F.col(c).cast("double").alias(c) for c in ("shipping_value", "tax_value", "refund_value")],
                 F.col("unique_items").cast("long").alias("unique_items")).alias("ecommerce"),
        "items",
        F.struct(F.col("device_category").alias("category"), F.col("device_os").alias("operating_system"),
                 F.col("device_language").alias("language"),
                 F.struct(F.col("browser").alias("browser"), F.col("browser_version").alias("browser_version"))
                 .alias("web_info")).alias("device"),
        F.struct("country", "region", "city").alias("geo"),
        F.struct(F.col("user_first_touch_campaign").alias("name")).alias("traffic_source"),
    ]
    if modern:
        cols += [
            F.struct(F.struct(F.col("last_click_source").alias("source"), F.col("last_click_medium").alias("medium"),
                              F.col("last_click_campaign").alias("campaign_name"), told("s-", "content").alias("content"),
                              told("s-", "term").alias("term")).alias("cross_channel_campaign"))
            .alias("session_traffic_source_last_click"),
            F.struct(coll[0].alias("manual_source"), coll[1].alias("manual_medium"),
                     coll[2].alias("manual_campaign_name"), told("m-", "content").alias("manual_content"),
                     told("m-", "term").alias("manual_term"),
                     *[F.concat(F.lit("c-"), F.col(c)).alias(c) for c in ("gclid", "dclid", "srsltid")])
            .alias("collected_traffic_source"),
            F.struct(F.col("privacy_analytics_storage").alias("analytics_storage"),
                     F.col("privacy_ads_storage").alias("ads_storage"),
                     F.col("privacy_uses_transient_token").alias("uses_transient_token")).alias("privacy_info"),
        ]
    return flat.select(*cols)

