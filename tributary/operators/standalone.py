"""Stand-alone script variants: purchase-only journeys, 8-way channels,
exact 30-day lookback, channel-level model reports, funnels from raw events.

Percentages divide by a one-row total (a scalar subquery), so no window runs
over all channels or paths. Top-k reports (top 50 / top 20) keep their LIMIT because the ranking is the
feature; every ranking has a full tie-break so the kept rows are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..plans.topk import by_fingerprint, first_groups, keep
from ..functions.util import exact_sum, round_to, safe_div
from .models import STANDALONE_MODEL_NAMES, standalone_weights

# --- fixed values (stand-alone funnel steps) -------------------------------------
FUNNEL_STEPS = (
    ("View Item", "view_item"), ("Add to Cart", "add_to_cart"), ("Begin Checkout", "begin_checkout"),
    ("Purchase", "purchase"),
)
# ------------------------------------------------------------------------------

_COUNT_MODELS = ("first_click", "last_click", "last_non_direct")
_SUM_MODELS = ("linear", "time_decay", "u_shape")


def _pct(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(safe_div(num.cast("double") * F.lit(100.0), den.cast("double")), digits)


def _top(df: DataFrame, n: int | None, *order) -> DataFrame:
    out = df.orderBy(*order)
    return out.limit(n) if n else out


def channel_report(journeys_sa: DataFrame, model: str, top: int | None = 50) -> DataFrame:
    """One stand-alone model's channel table.

    Single-touch models: channel, attributed_conversions (count), pct.
    Fractional models: channel, total_sessions (touchpoints), attributed
    conversions = ROUND(sum of weights, 4), pct of the global sum.
    """
    w = standalone_weights(journeys_sa)
    if model in _COUNT_MODELS:
        agg = w.where(F.col(f"w_{model}") > 0).groupBy("channel").agg(F.count(F.lit(1)).alias("attributed_conversions"))
        total = agg.agg(F.sum("attributed_conversions")).scalar()
        out = agg.select("channel", "attributed_conversions",
                         _pct(F.col("attributed_conversions"), total).alias("attribution_pct"))
        return _top(out, top, F.col("attributed_conversions").desc(), "channel")
    if model in _SUM_MODELS:
        agg = w.groupBy("channel").agg(F.count(F.lit(1)).alias("total_sessions"),
                                       exact_sum(f"w_{model}").alias("_w"))
        total = agg.agg(F.sum("_w")).scalar()
        out = agg.select("channel", "total_sessions", round_to(F.col("_w"), 4).alias("attributed_conversions"),
                         _pct(F.col("_w"), total).alias("attribution_pct"))
        return _top(out, top, F.col("attributed_conversions").desc(), "channel")
    raise ValueError(f"unknown stand-alone model {model!r}")


def cross_channel_wide(journeys_sa: DataFrame, top: int | None = 50) -> DataFrame:
    """One row per channel: six model columns and six percentage columns.
    A single grouped aggregation with conditional sums replaces the six
    per-model rollups and their left joins."""
    w = standalone_weights(journeys_sa)
    agg = w.groupBy("channel").agg(
        F.count(F.when(F.col("w_last_click") > 0, 1)).alias("last_click"),
        F.count(F.when(F.col("w_first_click") > 0, 1)).alias("first_click"),
        F.count(F.when(F.col("w_last_non_direct") > 0, 1)).alias("last_non_direct"),
        exact_sum("w_linear").alias("_lin"),
        exact_sum("w_time_decay").alias("_td"),
        exact_sum("w_u_shape").alias("_us"),
    )
    sums = ("last_click", "first_click", "last_non_direct", "_lin", "_td", "_us")
    total = agg.agg(F.struct(*[F.sum(c).alias(c) for c in sums])).scalar()  # one row
    out = agg.select(
        "channel", "last_click", "first_click", "last_non_direct",
        round_to(F.col("_lin"), 2).alias("linear"), round_to(F.col("_td"), 2).alias("time_decay"),
        round_to(F.col("_us"), 2).alias("u_shaped"),
        _pct(F.col("last_click"), total["last_click"]).alias("lc_pct"),
        _pct(F.col("first_click"), total["first_click"]).alias("fc_pct"),
        _pct(F.col("last_non_direct"), total["last_non_direct"]).alias("lnd_pct"),
        _pct(F.col("_lin"), total["_lin"]).alias("lin_pct"),
        _pct(F.col("_td"), total["_td"]).alias("td_pct"),
        _pct(F.col("_us"), total["_us"]).alias("us_pct"),
    )
    return _top(out, top, F.col("last_click").desc(), "channel")


def attribution_dashboard_long(journeys_sa: DataFrame) -> DataFrame:
    """model x channel: weight sum (rounded 4), pct within model, model total."""
    w = standalone_weights(journeys_sa)
    arr = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"w_{key}").alias("w"))
                    for key, name in STANDALONE_MODEL_NAMES.items()])
    e = w.select("channel", F.explode(arr).alias("m"))
    single = F.col("m.model").isin(*[STANDALONE_MODEL_NAMES[k] for k in _COUNT_MODELS])
    e = e.where(~single | (F.col("m.w") > 0))
    agg = e.groupBy(F.col("m.model").alias("model"), "channel").agg(exact_sum("m.w").alias("_c"))
    pm = Window.partitionBy("model")
    total = F.sum("_c").over(pm)
    return agg.select(
        "model", "channel", round_to(F.col("_c"), 4).alias("attributed_conversions"),
        _pct(F.col("_c"), total).alias("attribution_pct"),
        round_to(total, 6).alias("model_total"),
    )


def _capped_paths(journeys_sa: DataFrame, cap: int, top: int | None, count: str, aggs: list, store) -> tuple[DataFrame, Column]:
    """The first capped paths with their counts, grouped by fingerprint, and the count of all."""
    string = F.array_join("channel", " → ")
    rows = journeys_sa.select(F.slice("path.channel", 1, cap).alias("channel"), "path_length")
    keyed, groups = by_fingerprint(rows, string, [F.count(F.lit(1)).alias(count), *aggs])
    groups = keep(store)(groups)
    return first_groups(keyed, groups, string, "conversion_path", count, top), groups.agg(F.sum(count)).scalar()


def path_analysis_top(journeys_sa: DataFrame, cap: int = 20, top: int | None = 50, store=None) -> DataFrame:
    """Purchase paths capped at ``cap`` touches: count and share."""
    out, total = _capped_paths(journeys_sa, cap, top, "path_count", [], store)
    return out.select("conversion_path", "path_count", _pct(F.col("path_count"), total).alias("path_pct"))


def paths_dashboard_top(journeys_sa: DataFrame, cap: int = 10, top: int | None = 20, store=None) -> DataFrame:
    """Purchase paths capped at ``cap``: conversions, avg touchpoints, share."""
    out, total = _capped_paths(journeys_sa, cap, top, "conversions", [F.avg(F.col("path_length").cast("double")).alias("_avg")], store)
    return out.select("conversion_path", "conversions", F.round("_avg", 1).alias("avg_touchpoints"), _pct(F.col("conversions"), total).alias("pct_of_total"))


def purchase_funnel_steps(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Four steps from raw events (user-based): one pass of conditional
    distinct counts, then the 4 rows are built from that single row."""
    names = [e for _, e in FUNNEL_STEPS]
    ev = events.where(F.col("event_name").isin(*names))
    counts = ev.agg(*[F.countDistinct(F.when(F.col("event_name") == e, F.col("user_pseudo_id"))).alias(f"c{i}")
                      for i, e in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(label).alias("step"), F.col(f"c{i}").alias("users"),
                              (F.col(f"c{i - 1}") if i else F.lit(None).cast("bigint")).alias("prev"))
                     for i, (label, _) in enumerate(FUNNEL_STEPS)])
    e = counts.select("c0", F.explode(rows).alias("r"))
    return e.select(
        F.col("r.step").alias("step"), F.col("r.users").alias("users"),
        _pct(F.col("r.users"), F.col("r.prev")).alias("pct_of_previous"),
        _pct(F.col("r.users"), F.col("c0")).alias("pct_of_start"),
    )


def cart_abandonment_events(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Session-scoped abandonment from raw events: per (user, session) flags
    by MAX (map-side partial aggregate), then conditional distinct counts."""
    per = events.groupBy("user_pseudo_id", "session_id").agg(
        F.max((F.col("event_name") == "add_to_cart").cast("int")).alias("cart"),
        F.max((F.col("event_name") == "purchase").cast("int")).alias("purchased"),
    ).where(F.col("cart") == 1)
    key = F.concat(F.col("user_pseudo_id"), F.lit("-"), F.col("session_id").cast("string"))
    agg = per.agg(
        F.countDistinct(key).alias("total_cart_sessions"),
        F.countDistinct(F.when(F.col("purchased") == 0, key)).alias("abandoned_carts"),
        F.countDistinct(F.when(F.col("purchased") == 1, key)).alias("completed_purchases"),
    )
    return agg.select(
        "total_cart_sessions", "abandoned_carts", "completed_purchases",
        _pct(F.col("abandoned_carts"), F.col("total_cart_sessions")).alias("abandonment_rate_pct"),
        _pct(F.col("completed_purchases"), F.col("total_cart_sessions")).alias("conversion_rate_pct"),
    )


def session_acquisition(sessions_sa: DataFrame) -> DataFrame:
    """Sessions by resolved (first-non-auto) source, medium, campaign."""
    return sessions_sa.groupBy("source", "medium", "campaign").agg(F.count(F.lit(1)).alias("sessions"))


def session_acquisition_stslc(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Distinct ``user-session`` keys by the source (with defaults), medium and
    campaign of the event's last-click struct, whatever the source mode."""
    key = F.concat(F.col("user_pseudo_id"), F.lit("-"), F.col("session_id").cast("string"))
    return events.groupBy(
        F.coalesce("last_click_source", F.lit("(direct)")).alias("source"),
        F.coalesce("last_click_medium", F.lit("(none)")).alias("medium"),
        F.col("last_click_campaign").alias("campaign"),
    ).agg(F.countDistinct(key).alias("sessions"))
