"""Marts, funnels, paths and traffic reports over the pipeline layers.

All are aggregates over already-reduced layers (mart, journeys, sessions,
conversions). Global windows (``OVER ()``) only ever run on aggregated rows
whose count is bounded by the dimension sizes (stages, channels x models),
never on fact rows. Money and credit totals are exact DECIMAL sums.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.conversion import value_mode_case
from ..functions.paths import path_string
from ..plans.topk import by_fingerprint, first_groups, keep
from ..functions.util import exact_sum, round_to, safe_div, utc_date

# --- fixed values (funnel stages of the pipeline funnel) -----------------------
FUNNEL_STAGES = (
    ("add_to_cart", 1), ("begin_checkout", 2), ("add_shipping_info", 3), ("add_payment_info", 4),
    ("purchase", 5),
)
ABANDONMENT_STAGE_NUM = 99
# ------------------------------------------------------------------------------


def _pct(num, den, digits: int = 2):
    """ROUND(num * 100.0 / NULLIF(den, 0), digits)."""
    return F.round(safe_div(num.cast("double") * F.lit(100.0), den), digits)


def cross_channel(mart: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """model x conversion_event x value_mode x channel rollup of the counted
    mart (``models.counted_mart``), with the variance from last click (window over at most models x events x channels
    aggregated rows)."""
    agg = mart.groupBy(
        "model", "conversion_event", value_mode_case("conversion_event", cfg).alias("value_mode"), "channel",
    ).agg(
        F.sum("first_of_channel").alias("attributed_conversions"),
        exact_sum("attributed_credit").alias("_credit"),
        exact_sum("attributed_value_usd").alias("_usd"),
        exact_sum("attributed_value_local").alias("_local"),
    )
    return with_variance(agg)


def with_variance(agg: DataFrame) -> DataFrame:
    """Totals by model, event and channel (``_credit``, ``_usd``, ``_local``)
    rounded, with averages and the variance from last click."""
    credit = F.col("_credit").cast("double")
    base = agg.select(
        "model", "conversion_event", "value_mode", "channel", "attributed_conversions",
        round_to(F.col("_credit"), 6).alias("total_credit"),
        round_to(F.col("_usd"), 2).alias("total_value_usd"),
        round_to(F.col("_local"), 2).alias("total_value_local"),
        F.round(safe_div(F.col("_usd").cast("double"), credit), 2).alias("avg_attributed_value_usd"),
        F.round(safe_div(F.col("_local").cast("double"), credit), 2).alias("avg_attributed_value_local"),
    )
    w = Window.partitionBy("conversion_event", "channel")
    lc = F.sum(F.when(F.col("model") == "last_click", F.col("total_value_usd")).otherwise(F.lit(0.0))).over(w)
    return base.withColumn("variance_from_last_click_usd", F.round(F.col("total_value_usd") - lc, 2))


def attribution_dashboard(mart: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Row-level BI view: mart + value_mode + conversion_date."""
    return mart.select(
        "model", "conversion_event", value_mode_case("conversion_event", cfg).alias("value_mode"), "channel",
        "user_pseudo_id", "conversion_id", "conversion_ts", utc_date("conversion_ts").alias("conversion_date"),
        "transaction_id", "conversion_value_local", "conversion_value_usd", "path_length", "source", "medium",
        "campaign", "attributed_credit", "attributed_value_usd", "attributed_value_local",
    )


def paths_dashboard(journeys_df: DataFrame) -> DataFrame:
    """Journey rows with the path array and its ``A > B > C`` string."""
    return journeys_df.select(
        "user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "transaction_id",
        "conversion_value_local", "conversion_value_usd", "path_length", "path",
        path_string().alias("path_string"), "device_category", "device_os", "country", "city",
    )


def path_analysis(journeys_df: DataFrame, top: int = 100, min_conversions: int = 2,
                  store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Top paths with at least ``min_conversions`` conversions (all events
    mixed; one row of ``journeys_df`` each). ``top`` is the report's size (a
    top-k feature, not a row cap on the input); ties are broken by the path
    string. Paths are grouped by fingerprint; ``store`` keeps the groups."""
    keyed, groups = by_fingerprint(journeys_df.select("user_pseudo_id", "conversion_value_usd", "path_length", "path.channel"), F.array_join("channel", " > "), [
        F.countDistinct("user_pseudo_id").alias("unique_users"),
        F.count(F.lit(1)).alias("total_conversions"),
        exact_sum("conversion_value_usd").alias("_rev"),
        F.count("conversion_value_usd").alias("_nrev"),
        F.avg(F.col("path_length").cast("double")).alias("_len"),
    ])
    groups = keep(store)(groups.where(F.col("total_conversions") >= min_conversions))
    out = first_groups(keyed, groups, F.array_join("channel", " > "), "path_string", "total_conversions", top)
    return out.select(
        "path_string", "unique_users", "total_conversions",
        F.round(safe_div(F.col("_rev").cast("double"), F.col("_nrev")), 2).alias("avg_revenue_usd"),
        round_to(F.col("_rev"), 2).alias("total_revenue_usd"),
        F.round(F.col("_len"), 1).alias("avg_path_length"),
    )


def daily_traffic_overview(sessions_df: DataFrame) -> DataFrame:
    """Daily users / sessions / ratio by channel, source, medium."""
    key = F.concat(F.col("user_pseudo_id").cast("string"), F.lit("-"), F.col("session_id").cast("string"))
    agg = sessions_df.groupBy(
        utc_date("session_start").alias("session_date"), "channel", "source", "medium",
    ).agg(F.countDistinct("user_pseudo_id").alias("unique_users"), F.count(key).alias("total_sessions"))  # one row each
    return agg.withColumn("sessions_per_user", safe_div(F.col("total_sessions"), F.col("unique_users")))


# ---- funnels -------------------------------------------------------------------

def stage_num_case(event) -> "F.Column":
    """event -> stage number for the configured funnel stages, else NULL."""
    expr = None
    for stage, num in FUNNEL_STAGES:
        expr = (F.when(event == stage, F.lit(num)) if expr is None else expr.when(event == stage, F.lit(num)))
    return expr.cast("bigint")


def distinct_by_kind(rows: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """One row with the exact number of distinct non-null keys of each kind:
    keys become (kind, key) rows, equal ones meet in one aggregate with partial
    sums, and the rows left are counted. No row is copied for each distinct."""
    keyed = F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in kinds.items()])
    keys = rows.select(F.explode(keyed).alias("e")).select("e.*").where(F.col("key").isNotNull()).distinct()
    return keys.agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in kinds])


def stage_bit(event: Column) -> Column:
    """1, 2, 4, ... for the configured stages, else NULL."""
    return reduce(lambda c, s: c.when(event == s[0], 1 << (s[1] - 1)), FUNNEL_STAGES, F)


def funnel_shares(stages: DataFrame) -> DataFrame:
    """stage_num, stage, unique_users, unique_sessions, total_events,
    stage_revenue_usd -> with the percentages of the largest stage."""
    w = Window.partitionBy()  # <= 5 aggregated rows
    return stages.select(
        "stage_num", "stage", "unique_users", "unique_sessions", "total_events", "stage_revenue_usd",
        _pct(F.col("unique_users"), F.max("unique_users").over(w)).alias("pct_of_top_users"),
        _pct(F.col("unique_sessions"), F.max("unique_sessions").over(w)).alias("pct_of_top_sessions"),
    )


def purchase_funnel(conversions_df: DataFrame, qualified: bool = False) -> DataFrame:
    """Five-stage funnel from deduplicated conversions: users, sessions,
    events, revenue, pct of the largest stage. Session counts are by session id
    alone (not user-qualified) unless ``qualified``; stage order in time is not
    enforced. The reference joins a 5-row inline stage table; here the stage
    number is an in-row CASE, so no join (and no broadcast) is needed.

    One pass: every user and every session gathers the bits of its stages (a
    user also its events and revenue), and the bits are counted."""
    user = F.col("user_pseudo_id")
    sess = F.col("conversion_session_id").cast("string")
    sess = F.concat(user, F.lit("-"), sess) if qualified else sess
    f = conversions_df.where(F.col("conversion_event").isin(*[s for s, _ in FUNNEL_STAGES])).select(
        stage_num_case(F.col("conversion_event")).alias("stage_num"), stage_bit(F.col("conversion_event")).alias("bit"),
        F.col("purchase_revenue_in_usd").cast("decimal(38,10)").alias("usd"),
        F.explode(F.array(F.struct(F.lit("user").alias("kind"), user.cast("string").alias("key")), F.struct(F.lit("session").alias("kind"), sess.alias("key")))).alias("e"))
    f = f.withColumn("mine", F.col("e.kind") == "user")  # events and revenue count once
    sums = [x for _, n in FUNNEL_STAGES for x in (
        F.count(F.when(F.col("mine") & (F.col("stage_num") == n), 1)).alias(f"n{n}"), F.sum(F.when(F.col("mine") & (F.col("stage_num") == n), F.col("usd"))).alias(f"r{n}"))]
    keys = f.groupBy("e.kind", "e.key").agg(F.bit_or("bit").alias("bits"), *sums)
    each = F.array(*[F.struct(F.lit(n).cast("bigint").alias("stage_num"), F.lit(s).alias("stage"), (F.col("bits").bitwiseAND(F.lit(1 << (n - 1))) != 0).alias("hit"),
                              F.col(f"n{n}").alias("n"), F.col(f"r{n}").alias("r")) for s, n in FUNNEL_STAGES])
    rows = keys.select("kind", F.col("key").isNotNull().alias("known"), F.explode(each).alias("x")).where("x.hit")
    seen = lambda kind: F.count(F.when((F.col("kind") == kind) & F.col("known"), 1))
    return funnel_shares(rows.groupBy("x.stage_num", "x.stage").agg(
        seen("user").alias("unique_users"), seen("session").alias("unique_sessions"), F.sum("x.n").alias("total_events"), round_to(F.sum("x.r"), 2).alias("stage_revenue_usd")))


def _abandonment_row(agg: DataFrame) -> DataFrame:
    return agg.select(
        F.lit("add_to_cart").alias("stage"), "users_with_cart", "sessions_with_cart", "users_converted",
        "sessions_converted",
        _pct(F.col("users_with_cart") - F.col("users_converted"), F.col("users_with_cart")).alias("abandonment_rate_pct"),
    )


def cart_abandonment(conversions_df: DataFrame, user_scoped: bool = False) -> DataFrame:
    """Session-scoped abandonment: a (user, session) with a cart converts when
    it has a purchase too. A NULL session never does. One summary row, from one
    row of flags for each (user, session): no join.

    ``user_scoped=True`` is the per-user variant (purchase in any session
    counts): purchases are semi-joined to cart users, never paired with every
    cart session, and the same distinct counts are taken."""
    user, session = F.col("user_pseudo_id"), F.col("conversion_session_id")
    has = lambda e: F.max((F.col("conversion_event") == e).cast("int")) == 1
    visits = conversions_df.where(F.col("conversion_event").isin("add_to_cart", "purchase")).groupBy("user_pseudo_id", "conversion_session_id").agg(
        has("add_to_cart").alias("cart"), has("purchase").alias("bought"))
    if user_scoped:
        carted = visits.where("cart").select("user_pseudo_id").distinct()
        done = visits.where("bought").join(carted, "user_pseudo_id", "left_semi")
        visits = visits.where("cart").select("user_pseudo_id", "conversion_session_id", "cart", F.lit(False).alias("done")).unionByName(
            done.select("user_pseudo_id", "conversion_session_id", F.lit(False).alias("cart"), F.lit(True).alias("done")))
    else:
        visits = visits.withColumn("done", F.col("cart") & F.col("bought") & session.isNotNull() & user.isNotNull())
    return _abandonment_row(distinct_by_kind(visits, {
        "users_with_cart": F.when(F.col("cart"), user), "sessions_with_cart": F.when(F.col("cart"), session),
        "users_converted": F.when(F.col("done"), user), "sessions_converted": F.when(F.col("done"), session)}))


def funnel_dashboard(funnel_df: DataFrame, abandonment_df: DataFrame) -> DataFrame:
    """Funnel stages plus the abandonment row (stage_num 99), NULL-padded."""
    ab = abandonment_df.select(
        F.lit(ABANDONMENT_STAGE_NUM).cast("bigint").alias("stage_num"), "stage",
        F.col("users_with_cart").alias("unique_users"), F.col("sessions_with_cart").alias("unique_sessions"),
        "abandonment_rate_pct",
    )
    fu = funnel_df.withColumn("abandonment_rate_pct", F.lit(None).cast("double"))
    return fu.unionByName(ab, allowMissingColumns=True).select(
        F.col("stage_num").cast("bigint").alias("stage_num"), "stage", "unique_users", "unique_sessions",
        "total_events", "stage_revenue_usd", "pct_of_top_users", "pct_of_top_sessions", "abandonment_rate_pct")
