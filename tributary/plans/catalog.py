"""Registry of runnable queries over the driver's test tables.

Every entry takes ``(spark, sf_dir)``, maps the driver's ``events`` table
through the fixture projection, runs the operator over the whole table and
returns a DataFrame whose columns carry stable names (the DuckDB oracle in
:mod:`tributary.oracle` uses the same names). Nested columns (``path``,
``items``) are represented by scalar projections so results compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import path_string
from ..functions.util import exact_sum, round_to
from ..config import FIXTURE_CONFIG, ConversionEvent
from ..operators.data_driven import LogisticModel
from ..operators.models import MART_COLUMNS, RULE_MODELS
from .pipeline import Pipeline
from .session import save_partitioned, shared_dir

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def registry() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


# --- fixed values: a stated data-driven model (19 channel weights in the order of
# FEATURE_CHANNELS, then the intercept). The mart and its reports score with it, as
# a run does that loads a saved model; ``data_driven`` and the model_* queries fit. ---
STATED_WEIGHTS = (0.9, 0.4, 0.35, 0.2, 0.5, 0.15, -0.1, 0.05, 0.6, 0.3, 0.45, -0.3, 0.25, 0.55, 0.1, 0.2, -0.05, 0.12, -0.2)
STATED_INTERCEPT = -1.1

_PIPES: dict = {}


def pipe(spark: SparkSession, sf_dir: str) -> Pipeline:
    """One Pipeline per (session, data dir), so queries share stored layers."""
    key = (id(spark), sf_dir)
    if key not in _PIPES:
        p = Pipeline.from_fixture(spark, sf_dir)
        p.dd_model = LogisticModel(STATED_INTERCEPT, STATED_WEIGHTS)
        _PIPES[key] = p
    return _PIPES[key]


_FITTED: dict = {}
MODEL_DIGITS = 6  # fitted numbers are kept, reported and scored with that many decimals


def fitted(p: Pipeline) -> LogisticModel:
    """The model fitted on this pipeline's training table (once)."""
    from ..operators.data_driven import train_model
    if p.run_id not in _FITTED:
        _FITTED[p.run_id] = train_model(p.train_compact).rounded(MODEL_DIGITS)
    return _FITTED[p.run_id]


def fitted_legacy(p: Pipeline) -> LogisticModel:
    return p.sa_model.rounded(MODEL_DIGITS)


def release() -> None:
    """Delete the stored layers of all pipelines and forget them."""
    for p in _PIPES.values():
        p.cleanup()
    _PIPES.clear()
    _FITTED.clear()


def _path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{shared_dir(spark)}/catalog/{name}-{uuid.uuid4().hex}"


SESSION_OUT = ("user_pseudo_id", "session_id", "session_start", "source", "medium", "campaign", "content",
               "term", "channel", "device_category", "country", "session_start_us")
CONVERSION_OUT = ("user_pseudo_id", "conversion_ts", "conversion_event", "event_date", "platform",
                  "transaction_id", "purchase_revenue", "purchase_revenue_in_usd", "event_value",
                  "event_currency", "device_category", "country", "conversion_session_id")
JOURNEY_OUT = ("user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "event_date", "platform",
               "transaction_id", "conversion_value_local", "conversion_value_usd", "device_category", "country",
               "conversion_session_id", "path_length", "user_conversion_seq")
PATH_ROW_OUT = ("user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "transaction_id",
                "conversion_value_usd", "path_length", "session_id", "session_start", "source", "medium",
                "campaign", "channel", "hours_before_conversion", "session_position_asc", "session_position_desc")


@register("sessions")
def q_sessions(spark, sf_dir):
    return pipe(spark, sf_dir).sessions.select(*SESSION_OUT)


@register("conversions")
def q_conversions(spark, sf_dir):
    return pipe(spark, sf_dir).conversions.select(*CONVERSION_OUT)


@register("journeys")
def q_journeys(spark, sf_dir):
    j = pipe(spark, sf_dir).journeys
    return j.select(*JOURNEY_OUT, path_string().alias("path_string"))


@register("path_rows")
def q_path_rows(spark, sf_dir):
    return pipe(spark, sf_dir).path_rows.select(*PATH_ROW_OUT)


@register("attribution_mart")
def q_mart(spark, sf_dir):
    return pipe(spark, sf_dir).rule_mart


def _model_query(name):
    def fn(spark, sf_dir):
        return pipe(spark, sf_dir).model(name)
    fn.__name__ = f"q_{name}"
    return fn


for _m in RULE_MODELS:
    register(_m)(_model_query(_m))


@register("top_channels_last_click")
def q_top_channels_last_click(spark, sf_dir):
    m = pipe(spark, sf_dir).model("last_click")
    return (m.where((F.col("model") == "last_click") & (F.col("conversion_event") == "purchase"))
            .groupBy("channel")
            .agg(round_to(exact_sum("attributed_value_usd"), 6).alias("revenue"),
                 F.count(F.lit(1)).alias("conversions"))  # one row for each
            .orderBy(F.col("revenue").desc(), "channel"))


# ---- sources ---------------------------------------------------------------------

READ_OUT = ("event_date", "event_timestamp", "event_name", "user_pseudo_id", "session_id", "source", "medium",
            "campaign", "transaction_id", "purchase_revenue", "purchase_revenue_in_usd", "device_category", "country",
            "event_value", "event_currency", "gclid", "dclid", "srsltid", "msclkid", "fbclid", "ttclid", "twclid", "li_fat_id",
            "page_location", "page_referrer", "hostname", "content", "term", "user_first_touch_campaign", "device_os", "device_language",
            "browser", "browser_version", "region", "city", "total_item_quantity", "shipping_value", "tax_value", "refund_value",
            "unique_items", "event_quantity", "privacy_analytics_storage", "privacy_ads_storage", "privacy_uses_transient_token")


def read_out(flat: DataFrame) -> DataFrame:
    """All flat fields; the items as a string."""
    item = lambda x: F.concat_ws("|", x["item_id"], x["item_name"], x["quantity"], (x["price"] * 100).cast("long"))
    return flat.select(*READ_OUT, F.array_join(F.transform("items", item), ",").alias("items"))


def export_files(spark, sf_dir) -> str:
    """The nested export written as files partitioned by event_date."""
    from ..sources.fixtures import fixture_events_nested
    path = _path(spark, "export")
    save_partitioned(fixture_events_nested(spark, sf_dir), path, ["event_date"])
    return path


def _read_query(**options):
    def fn(spark, sf_dir):
        """Files of the nested export -> partition-pruned scan -> flatten."""
        from ..sources.events import flatten_events, read_events
        cfg = pipe(spark, sf_dir).cfg.with_(has_privacy_info=True, **options)
        return read_out(flatten_events(read_events(spark, export_files(spark, sf_dir), cfg), cfg))
    return fn


register("read_events")(_read_query(source_mode="auto"))
register("read_events_params")(_read_query(source_mode="event_params"))
register("read_events_last_click")(_read_query(source_mode="session_stslc"))
register("read_events_collected")(_read_query(source_mode="collected"))
register("read_events_not_modeled")(_read_query(source_mode="auto", exclude_modeled_events=True))
register("read_events_unwidened")(_read_query(source_mode="auto", widen_scan=False))


SCHEMA_CHANGE = "20240120"  # fixed value: the day from which the export of the fixture has all its structs


def shard_files(spark, sf_dir) -> str:
    """The nested export as one table for each day. Days before the change lack
    the traffic and consent structs, the tax and the browser's version, and have
    narrower numbers; one out of range is no table at all."""
    from ..sources.fixtures import fixture_events_nested
    from ..sources.shards import SHARD
    root = _path(spark, "shards")
    new = fixture_events_nested(spark, sf_dir)
    old = new.where(F.col("event_date") < SCHEMA_CHANGE).drop("session_traffic_source_last_click", "collected_traffic_source", "privacy_info")
    old = old.withColumn("ecommerce", F.col("ecommerce").dropFields("tax_value").withField("shipping_value", F.col("ecommerce.shipping_value").cast("float")))
    old = old.withColumn("device", F.col("device").withField("web_info", F.col("device.web_info").dropFields("browser_version")))
    for name, part in (("old", old), ("new", new.where(F.col("event_date") >= SCHEMA_CHANGE))):
        save_partitioned(part.withColumn("day", F.col("event_date")), f"{root}-{name}", ["day"])
        fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}-{name}")):
            if s.getPath().getName().startswith("day="):
                to = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/events_{s.getPath().getName()[4:]}")
                assert SHARD.match(to.getName())
                fs.mkdirs(to.getParent())
                fs.rename(s.getPath(), to)
    spark.createDataFrame([("no event",)], "value string").write.text(f"{root}/events_20200101")
    return root


@register("read_events_sharded")
def q_read_sharded(spark, sf_dir):
    from ..sources.shards import read_sharded_events
    cfg = pipe(spark, sf_dir).cfg.with_(has_privacy_info=True, source_mode="auto")
    return read_out(read_sharded_events(spark, shard_files(spark, sf_dir), cfg))


@register("channel_grouping_19")
def q_channels_19(spark, sf_dir):
    """Every event's traffic through the 19-way grouping."""
    from ..functions.channels import channel_grouping_19
    ev = pipe(spark, sf_dir).events.select(F.coalesce("medium", F.lit("(none)")).alias("medium"), F.coalesce("source", F.lit("(direct)")).alias("source"),
                                           F.coalesce("campaign", F.lit("")).alias("campaign"))
    return ev.groupBy("source", "medium", "campaign", channel_grouping_19("medium", "source", "campaign").alias("channel")).agg(
        F.count(F.lit(1)).alias("events"))


# ---- sinks -------------------------------------------------------------------------

@register("write_table")
def q_write_table(spark, sf_dir):
    """A first version with half of the sessions, then the whole as the next one."""
    from ..streaming.tables import read_table, write_table
    path, sessions = _path(spark, "table"), pipe(spark, sf_dir).sessions
    write_table(sessions.where(F.col("session_id") % 2 == 0), path, partition_by=["channel"])
    write_table(sessions, path, partition_by=["channel"])
    return read_table(spark, path).select(*SESSION_OUT)


@register("register_view")
def q_register_view(spark, sf_dir):
    """A view over a published table, opened by another session."""
    from ..streaming.tables import open_view, register_view, write_table
    path, views = _path(spark, "conversions"), _path(spark, "views")
    write_table(pipe(spark, sf_dir).conversions, path, partition_by=["event_date"])
    register_view(spark, views, "staged", "SELECT * FROM {conversions}", {"conversions": path})
    register_view(spark, views, "report", f"SELECT {', '.join(CONVERSION_OUT)} FROM {{staged}}", {"staged": "view:staged"})
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return open_view(other, views, "report")


@register("write_incremental")
def q_write_incremental(spark, sf_dir):
    """A table without revenue; then the days from 20 January are replaced."""
    from ..streaming.tables import read_table, write_incremental, write_table
    path, c = _path(spark, "incremental"), pipe(spark, sf_dir).conversions.select(*CONVERSION_OUT)
    write_table(c.withColumn("purchase_revenue", F.lit(None).cast("double")), path, partition_by=["event_date"])
    write_incremental(c.where(F.col("event_date") >= "20240120"), path, "event_date")
    return read_table(spark, path)


def _refreshed(spark, sf_dir, table):
    """Staging built without the events of k % 9 = 0, which then arrive late
    for all days but the first three, and a refresh of the days they touch."""
    from ..sources.fixtures import FLAT_EVENT_COLUMNS, fixture_base
    from ..streaming.incremental import days_between, refresh_staging
    from ..streaming.tables import read_table
    out, cfg, base = _path(spark, "staging"), pipe(spark, sf_dir).cfg, fixture_base(spark, sf_dir)
    late = (F.col("_k") % 9 == 0) & (F.col("event_date") >= "20240118")
    refresh_staging(base.where(~late).select(*FLAT_EVENT_COLUMNS), cfg, out, days_between(cfg.scan_start_date, cfg.end_date))
    refresh_staging(base.select(*FLAT_EVENT_COLUMNS), cfg, out, days_between("20240118", cfg.end_date))
    return read_table(spark, f"{out}/{table}")


@register("refresh_staging_sessions")
def q_refresh_sessions(spark, sf_dir):
    return _refreshed(spark, sf_dir, "stg_sessions").select(*SESSION_OUT)


@register("refresh_staging_conversions")
def q_refresh_conversions(spark, sf_dir):
    return _refreshed(spark, sf_dir, "stg_conversions").select(*CONVERSION_OUT)


# ---- stand-alone staging -----------------------------------------------------------

@register("sessions_first_non_auto")
def q_sessions_fna(spark, sf_dir):
    return pipe(spark, sf_dir).sa_sessions


@register("conversions_purchase")
def q_conversions_purchase(spark, sf_dir):
    return pipe(spark, sf_dir).sa_conversions.drop("conversion_us")


@register("journeys_exact30")
def q_journeys_exact30(spark, sf_dir):
    j = pipe(spark, sf_dir).sa_journeys
    return j.select("user_pseudo_id", "conversion_ts", "conversion_id", "conversion_revenue", "transaction_id",
                    "path_length", path_string().alias("path_string"))


@register("path_rows_standalone")
def q_path_rows_sa(spark, sf_dir):
    return pipe(spark, sf_dir).sa_path_rows


@register("session_acquisition")
def q_session_acq(spark, sf_dir):
    from ..operators.standalone import session_acquisition
    return session_acquisition(pipe(spark, sf_dir).sa_sessions)


@register("session_acquisition_stslc")
def q_session_acq_stslc(spark, sf_dir):
    from ..operators.standalone import session_acquisition_stslc
    p = pipe(spark, sf_dir)
    return session_acquisition_stslc(p.sa_events, p.sa_cfg)


# ---- marts, funnels, paths, traffic -------------------------------------------------

@register("cross_channel")
def q_cross_channel(spark, sf_dir):
    return pipe(spark, sf_dir).cross_channel


@register("attribution_dashboard")
def q_attribution_dashboard(spark, sf_dir):
    return pipe(spark, sf_dir).dashboard


@register("paths_dashboard")
def q_paths_dashboard(spark, sf_dir):
    from ..operators.reports import paths_dashboard
    return paths_dashboard(pipe(spark, sf_dir).journeys).drop("path")


@register("path_analysis")
def q_path_analysis(spark, sf_dir):
    return pipe(spark, sf_dir).path_analysis


@register("daily_traffic_overview")
def q_traffic(spark, sf_dir):
    return pipe(spark, sf_dir).traffic


@register("purchase_funnel")
def q_funnel(spark, sf_dir):
    return pipe(spark, sf_dir).funnel


@register("purchase_funnel_by_days")
def q_funnel_days(spark, sf_dir):
    """The funnel from stored days: all but the last four, then these (with one more day again)."""
    from ..operators.day_sets import add_days, funnel_of_days
    from ..streaming.incremental import days_between
    p, folder = pipe(spark, sf_dir), _path(spark, "days")
    days = days_between(p.cfg.scan_start_date, p.cfg.end_date)  # a property's days need not be UTC days
    add_days(p.conversions, folder, days[:-4])
    add_days(p.conversions, folder, days[-5:])
    return funnel_of_days(spark, folder, days[0], days[-1])


@register("cart_abandonment")
def q_abandonment(spark, sf_dir):
    return pipe(spark, sf_dir).abandonment


@register("cart_abandonment_user")
def q_abandonment_user(spark, sf_dir):
    from ..operators.reports import cart_abandonment
    return cart_abandonment(pipe(spark, sf_dir).conversions, user_scoped=True)


@register("funnel_dashboard")
def q_funnel_dashboard(spark, sf_dir):
    from ..operators.reports import funnel_dashboard
    p = pipe(spark, sf_dir)
    return funnel_dashboard(p.funnel, p.abandonment)


# ---- stand-alone reports ---------------------------------------------------------------

def _sa_channel(model):
    def fn(spark, sf_dir):
        from ..operators.standalone import channel_report
        return channel_report(pipe(spark, sf_dir).sa_journeys, model)
    return fn


for _m, _key in (("first_click", "first_click_channel"), ("last_click", "last_click_channel"),
                 ("last_non_direct", "last_non_direct_channel"), ("linear", "linear_channel"),
                 ("time_decay", "time_decay_channel"), ("u_shape", "u_shape_channel")):
    register(_key)(_sa_channel(_m))


@register("cross_channel_wide")
def q_cross_channel_wide(spark, sf_dir):
    from ..operators.standalone import cross_channel_wide
    return cross_channel_wide(pipe(spark, sf_dir).sa_journeys)


@register("attribution_dashboard_long")
def q_dashboard_long(spark, sf_dir):
    from ..operators.standalone import attribution_dashboard_long
    return attribution_dashboard_long(pipe(spark, sf_dir).sa_journeys)


@register("attribution_mart_legacy")
def q_mart_legacy(spark, sf_dir):
    from ..operators.models import attribution_mart_legacy
    return attribution_mart_legacy(pipe(spark, sf_dir).sa_journeys).select(
        "user_pseudo_id", "conversion_ts", "model", "channel",
        F.round("attributed_conversions", 9).alias("attributed_conversions"))


@register("path_analysis_top50")
def q_path_top50(spark, sf_dir):
    from ..operators.standalone import path_analysis_top
    p = pipe(spark, sf_dir)
    return path_analysis_top(p.sa_journeys, cap=20, top=50, store=p._store("sa_paths20"))


@register("paths_dashboard_top20")
def q_paths_top20(spark, sf_dir):
    from ..operators.standalone import paths_dashboard_top
    p = pipe(spark, sf_dir)
    return paths_dashboard_top(p.sa_journeys, cap=10, top=20, store=p._store("sa_paths10"))


@register("purchase_funnel_steps")
def q_funnel_steps(spark, sf_dir):
    from ..operators.standalone import purchase_funnel_steps
    p = pipe(spark, sf_dir)
    return purchase_funnel_steps(p.sa_events, p.sa_cfg)


@register("cart_abandonment_events")
def q_abandonment_events(spark, sf_dir):
    from ..operators.standalone import cart_abandonment_events
    p = pipe(spark, sf_dir)
    return cart_abandonment_events(p.sa_events, p.sa_cfg)


# ---- data quality -----------------------------------------------------------------------

@register("dq_conversions_assertions")
def q_dq_conv(spark, sf_dir):
    from ..operators.quality import CONVERSION_ASSERTIONS, assertion_failures
    return assertion_failures(pipe(spark, sf_dir).conversions, CONVERSION_ASSERTIONS)


@register("dq_journeys_assertions")
def q_dq_journeys(spark, sf_dir):
    from ..operators.quality import JOURNEY_ASSERTIONS, assertion_failures
    return assertion_failures(pipe(spark, sf_dir).journeys, JOURNEY_ASSERTIONS)


@register("dq_path_rows_assertions")
def q_dq_path_rows(spark, sf_dir):
    from ..operators.quality import PATH_ROW_ASSERTIONS, assertion_failures
    return assertion_failures(pipe(spark, sf_dir).path_rows, PATH_ROW_ASSERTIONS)


@register("dq_credit_sums")
def q_dq_credit(spark, sf_dir):
    from ..operators.quality import dq_credit_sums
    return dq_credit_sums(pipe(spark, sf_dir).mart)


@register("dq_unknown_events")
def q_dq_unknown(spark, sf_dir):
    from ..operators.quality import dq_unknown_events
    p = pipe(spark, sf_dir)
    return dq_unknown_events(p.mart, p.cfg)


@register("dq_revenue_conservation")
def q_dq_revenue(spark, sf_dir):
    from ..operators.quality import dq_revenue_conservation
    p = pipe(spark, sf_dir)
    return dq_revenue_conservation(p.mart, p.journeys, p.cfg)


@register("dq_count_mode_null")
def q_dq_count_null(spark, sf_dir):
    from ..operators.quality import dq_count_mode_null
    p = pipe(spark, sf_dir)
    return dq_count_mode_null(p.mart, p.cfg)


@register("dq_channel_coverage")
def q_dq_channels(spark, sf_dir):
    from ..operators.quality import dq_channel_coverage
    return dq_channel_coverage(pipe(spark, sf_dir).mart)


@register("dq_session_dupes")
def q_dq_session_dupes(spark, sf_dir):
    from ..operators.quality import dq_session_dupes
    return dq_session_dupes(pipe(spark, sf_dir).sessions)


@register("dq_journey_dupes")
def q_dq_journey_dupes(spark, sf_dir):
    from ..operators.quality import dq_journey_dupes
    return dq_journey_dupes(pipe(spark, sf_dir).journeys)


@register("dq_last_non_direct_forms")
def q_dq_lnd_forms(spark, sf_dir):
    from ..operators.models import last_non_direct_click_full_outer
    from ..operators.quality import lnd_forms_agree
    p = pipe(spark, sf_dir)
    return lnd_forms_agree(p.model("last_non_direct_click"), last_non_direct_click_full_outer(p.path_rows, p.cfg))


# the same checks over rows that break them, derived from the mart by user id

FIXED_EVENTS = tuple(e if e.event != "add_to_cart" else ConversionEvent("add_to_cart", "fixed", None, 2.5, 7)
                     for e in FIXTURE_CONFIG.conversion_events)


def broken_mart(p: Pipeline) -> DataFrame:
    """Users by last digit: 0 too much linear credit, 1 an unknown event, 2 a
    value where the model counts, 4 an unknown channel, 5 lost revenue."""
    digit, model = F.col("user_pseudo_id").cast("long") % 10, F.col("model")
    return p.mart.withColumns({
        "attributed_credit": F.when((digit == 0) & (model == "linear"), F.col("attributed_credit") + 0.25).otherwise(F.col("attributed_credit")),
        "conversion_event": F.when((digit == 1) & (model == "last_click"), "mystery").otherwise(F.col("conversion_event")),
        "attributed_value_usd": F.when((digit == 2) & (model == "u_shape"), 1.0).when((digit == 5) & (model == "first_click"), 0.0)
        .otherwise(F.col("attributed_value_usd")),
        "channel": F.when((digit == 4) & (model == "first_click"), "Nonsense").otherwise(F.col("channel")),
    })


def _broken(check):
    def fn(spark, sf_dir):
        from ..operators import quality
        return check(quality, pipe(spark, sf_dir))
    return fn


def _doubled(df: DataFrame, digit: int) -> DataFrame:
    return df.unionByName(df.where(F.col("user_pseudo_id").cast("long") % 10 == digit))


def broken_conversions(p: Pipeline) -> DataFrame:
    """Rows of digit 6 twice, of 7 with negative revenue, of 8 without a user."""
    digit = F.col("user_pseudo_id").cast("long") % 10
    c = _doubled(p.conversions, 6)
    return c.withColumns({"purchase_revenue_in_usd": F.when(digit == 7, -1.0).otherwise(F.col("purchase_revenue_in_usd")),
                          "user_pseudo_id": F.when(digit != 8, F.col("user_pseudo_id"))})


for _name, _check in {
    "dq_credit_sums_broken": lambda q, p: q.dq_credit_sums(broken_mart(p)),
    "dq_unknown_events_broken": lambda q, p: q.dq_unknown_events(broken_mart(p), p.cfg),
    "dq_revenue_conservation_broken": lambda q, p: q.dq_revenue_conservation(broken_mart(p), p.journeys, p.cfg),
    "dq_count_mode_null_broken": lambda q, p: q.dq_count_mode_null(broken_mart(p), p.cfg),
    "dq_channel_coverage_broken": lambda q, p: q.dq_channel_coverage(broken_mart(p)),
    "dq_session_dupes_broken": lambda q, p: q.dq_session_dupes(_doubled(p.sessions, 4)),
    "dq_journey_dupes_broken": lambda q, p: q.dq_journey_dupes(_doubled(p.journeys, 5)),
    "dq_conversions_assertions_broken": lambda q, p: q.assertion_failures(broken_conversions(p), q.CONVERSION_ASSERTIONS),
    "dq_not_null_broken": lambda q, p: q.dq_not_null(broken_conversions(p), ["user_pseudo_id", "conversion_ts"]).groupBy("null_column").agg(F.count(F.lit(1)).alias("rows")),
    "dq_row_condition_broken": lambda q, p: q.dq_row_condition(broken_conversions(p), "purchase_revenue_in_usd >= 0").groupBy("conversion_event").agg(F.count(F.lit(1)).alias("rows")),
    "dq_unique_broken": lambda q, p: q.dq_unique(broken_conversions(p), ["user_pseudo_id", "conversion_ts", "conversion_event", "transaction_id"]).agg(F.sum("dupes").alias("rows")),
}.items():
    register(_name)(_broken(_check))


def _audited(spark, p: Pipeline, mart: DataFrame) -> DataFrame:
    """The checks of a mart that is written with them, published or not."""
    from ..operators.quality import mart_metrics, mart_report
    from ..streaming.tables import AuditError, write_audited
    failing = lambda m: [c for c, n in mart_report(m) if n]
    try:
        metrics = write_audited(mart, _path(spark, "mart"), mart_metrics(p.cfg, (*RULE_MODELS, "data_driven_bqml")), failing, ["model"])
    except AuditError as e:
        metrics = e.metrics
    return spark.createDataFrame(mart_report(metrics), "check string, failing_rows long")


@register("dq_mart_audit")
def q_dq_audit(spark, sf_dir):
    p = pipe(spark, sf_dir)
    return _audited(spark, p, p.mart)


@register("dq_mart_audit_broken")
def q_dq_audit_broken(spark, sf_dir):
    p = pipe(spark, sf_dir)
    return _audited(spark, p, broken_mart(p))


@register("value_fixed_mode")
def q_value_fixed(spark, sf_dir):
    """The linear model with add_to_cart worth a fixed 2.5 USD."""
    from ..operators.models import single_model
    p = pipe(spark, sf_dir)
    return single_model(p.journeys, p.cfg.with_(conversion_events=FIXED_EVENTS), "linear")


@register("dq_fixed_mode")
def q_dq_fixed(spark, sf_dir):
    """Fixed-mode rows against their constant; the broken credits show up."""
    from ..operators.quality import dq_fixed_mode
    p = pipe(spark, sf_dir)
    cfg = p.cfg.with_(conversion_events=FIXED_EVENTS)
    fixed = F.when(F.col("conversion_event") == "add_to_cart", 2.5 * F.col("attributed_credit")).otherwise(F.col("attributed_value_usd"))
    mart = p.mart.withColumn("attributed_value_usd", fixed)
    off = (F.col("user_pseudo_id").cast("long") % 10 == 9) & (F.col("model") == "time_decay")
    return dq_fixed_mode(mart.withColumn("attributed_value_usd", F.when(off, F.col("attributed_value_usd") + 1).otherwise(F.col("attributed_value_usd"))), cfg)


# ---- cost ----------------------------------------------------------------------------------

def _cost_files(spark, sf_dir, fmt, *systems) -> dict[str, str]:
    """The fixture cost of some platforms, written as files."""
    from ..sources.cost import fixture_cost
    out = {}
    for x in systems:
        out[x] = _path(spark, f"cost-{x}")
        fixture_cost(spark, sf_dir).where(F.col("source_system") == x).drop("source_system").write.format(fmt).option("header", True).save(out[x])
    return out


@register("read_cost_google")
def q_cost_google(spark, sf_dir):
    from ..sources.cost import read_cost_google
    return read_cost_google(spark, _cost_files(spark, sf_dir, "parquet", "google_ads")["google_ads"])


@register("read_cost_meta")
def q_cost_meta(spark, sf_dir):
    from ..sources.cost import read_cost_meta
    return read_cost_meta(spark, _cost_files(spark, sf_dir, "json", "meta_ads")["meta_ads"], fmt="json")


@register("read_cost_other")
def q_cost_other(spark, sf_dir):
    from ..sources.cost import read_cost_other
    files = _cost_files(spark, sf_dir, "csv", "tiktok", "linkedin")
    # Spark's CSV writer leaves empty strings quoted, and reads them back as such
    one = lambda x: read_cost_other(spark, files[x], "csv", {"header": "true", "emptyValue": ""}, x)
    return one("tiktok").unionByName(one("linkedin"))


@register("google_ads_channel_map")
def q_google_channel_map(spark, sf_dir):
    """Transfer rows derived from the events: a channel type by k, micros by value."""
    from ..sources.cost import google_ads_cost
    from ..sources.fixtures import fixture_base
    types = F.array(*[F.lit(x) for x in ("SEARCH", "DISPLAY", "SHOPPING", "VIDEO", "PERFORMANCE_MAX", "HOTEL")])
    raw = fixture_base(spark, sf_dir).groupBy(F.to_date("event_date", "yyyyMMdd").alias("date"), (F.col("_k") % 6).alias("t")).agg(
        F.sum((F.col("_value") * 1000000).cast("long")).alias("cost_micros"), F.count(F.lit(1)).alias("impressions"), F.lit(0).cast("long").alias("clicks"))
    raw = raw.select("date", F.get(types, F.col("t").cast("int")).alias("campaign_advertising_channel_type"),
                     F.lit("c").alias("campaign_name"), "cost_micros", "impressions", "clicks")
    return google_ads_cost(raw)


@register("unified_cost")
def q_unified_cost(spark, sf_dir):
    return pipe(spark, sf_dir).unified_cost


@register("roas")
def q_roas(spark, sf_dir):
    return pipe(spark, sf_dir).roas


@register("roas_with_data_driven")
def q_roas_dd(spark, sf_dir):
    return pipe(spark, sf_dir).roas


# ---- data-driven ---------------------------------------------------------------------------

@register("train_set")
def q_train_set(spark, sf_dir):
    return pipe(spark, sf_dir).train_compact


@register("model_weights")
def q_model_weights(spark, sf_dir):
    """Fitted coefficients (19 flags + intercept), largest |weight| first."""
    return fitted(pipe(spark, sf_dir)).weights_frame(spark)


@register("model_certificate")
def q_model_certificate(spark, sf_dir):
    """The fitted model's score equations and the weight of each feature's rows."""
    from ..operators.data_driven import model_certificate
    p = pipe(spark, sf_dir)
    return model_certificate(p.train_compact, fitted(p))


@register("model_evaluate")
def q_model_evaluate(spark, sf_dir):
    from ..operators.data_driven import model_evaluate
    p = pipe(spark, sf_dir)
    return model_evaluate(p.train_compact, fitted(p))


@register("data_driven")
def q_data_driven(spark, sf_dir):
    """Scored with the model fitted on the training table, saved and loaded."""
    from ..operators.data_driven import data_driven
    p, path = pipe(spark, sf_dir), _path(spark, "model")
    fitted(p).save(spark, path)
    return data_driven(p.journeys, LogisticModel.load(spark, path), p.cfg).select(*MART_COLUMNS)


@register("data_driven_stated")
def q_data_driven_stated(spark, sf_dir):
    return pipe(spark, sf_dir).data_driven


@register("attribution_mart_full")
def q_mart_full(spark, sf_dir):
    return pipe(spark, sf_dir).mart


@register("dq_model_event_rows")
def q_dq_model_rows(spark, sf_dir):
    from ..operators.quality import dq_model_event_rows
    return dq_model_event_rows(pipe(spark, sf_dir).data_driven)


@register("dq_channel_coverage_data_driven")
def q_dq_dd_channels(spark, sf_dir):
    from ..operators.quality import dq_channel_coverage
    return dq_channel_coverage(pipe(spark, sf_dir).data_driven)


@register("journey_features")
def q_journey_features(spark, sf_dir):
    return pipe(spark, sf_dir).sa_features


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    from ..operators.data_driven import feature_importance
    p = pipe(spark, sf_dir)
    return feature_importance(fitted_legacy(p), spark)


@register("data_driven_legacy")
def q_dd_legacy(spark, sf_dir):
    from ..operators.data_driven import data_driven_legacy
    p = pipe(spark, sf_dir)
    return data_driven_legacy(p.sa_features, fitted_legacy(p))


@register("channel_volume")
def q_channel_volume(spark, sf_dir):
    from ..operators.data_driven import channel_volume
    p = pipe(spark, sf_dir)
    return channel_volume(p.sa_events, p.sa_cfg)


# ---- BI recipes -------------------------------------------------------------------------------

def _bi(name, build):
    register(name)(build)


def _reg_bi():
    from ..operators import bi

    _bi("model_summary", lambda s, d: bi.model_summary(pipe(s, d).counted))
    _bi("channel_summary", lambda s, d: bi.channel_summary(pipe(s, d).cross_channel))
    _bi("top_paths", lambda s, d: bi.top_paths(pipe(s, d).path_analysis))
    _bi("daily_revenue_by_model", lambda s, d: bi.daily_revenue_by_model(pipe(s, d).mart))
    _bi("path_length_revenue", lambda s, d: bi.path_length_revenue(pipe(s, d).model("last_click")))
    _bi("longest_journeys", lambda s, d: bi.longest_journeys(pipe(s, d).journeys).select(*JOURNEY_OUT))
    _bi("kpi_totals", lambda s, d: bi.kpi_totals(pipe(s, d).mart))
    _bi("aov", lambda s, d: bi.aov(pipe(s, d).mart))
    _bi("share_of_conversions", lambda s, d: bi.share_of_conversions(pipe(s, d).mart))
    _bi("channel_model_heatmap", lambda s, d: bi.channel_model_heatmap(pipe(s, d).mart))
    _bi("channel_model_heatmap_credit", lambda s, d: bi.channel_model_heatmap(pipe(s, d).mart, "credit"))
    _bi("channel_model_heatmap_aov", lambda s, d: bi.channel_model_heatmap(pipe(s, d).mart, "aov"))
    _bi("path_length_histogram", lambda s, d: bi.path_length_histogram(pipe(s, d).journeys, bucket_from=10))
    _bi("revenue_by_path_length", lambda s, d: bi.revenue_by_path_length(pipe(s, d).journeys))
    _bi("device_breakdown", lambda s, d: bi.device_breakdown(pipe(s, d).journeys))
    _bi("sessions_per_user", lambda s, d: bi.sessions_per_user(pipe(s, d).traffic))
    _bi("traffic_mix", lambda s, d: bi.traffic_mix(pipe(s, d).traffic))
    _bi("daily_users_by_channel", lambda s, d: bi.daily_users_by_channel(pipe(s, d).traffic))
    _bi("converting_users", lambda s, d: bi.converting_users(pipe(s, d).dashboard))
    _bi("conversion_rate_proxy", lambda s, d: bi.conversion_rate_proxy(pipe(s, d).traffic, pipe(s, d).dashboard))
    _bi("model_delta_daily", lambda s, d: bi.model_delta_daily(pipe(s, d).mart))
    _bi("channel_share_per_model", lambda s, d: bi.channel_share_per_model(pipe(s, d).mart))
    _bi("wow_revenue_change", lambda s, d: bi.wow_revenue_change(pipe(s, d).mart))


_reg_bi()
