"""Rule-based attribution models.

All seven pipeline models are computed in ONE narrow pass over the journeys:
per-journey scalars (path length, time-decay normaliser, last-non-direct
position) come from higher-order functions over the ``path`` array, then
``posexplode`` yields touchpoints and each touchpoint emits one row per model
that credits it. No window, no self-join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    HALF_LIFE_HOURS,
    STANDALONE_DECAY_CAP_HOURS,
    STANDALONE_DECAY_RATE,
    AttributionConfig,
)
from ..functions.conversion import value_expr

# --- fixed values (model ids of the mart, in the reference's union order) ------
RULE_MODELS = (
    "first_click", "last_click", "last_non_direct_click", "linear", "time_decay", "u_shape",
    "position_weighted",
)
# Columns of the fact table, in order.
MART_COLUMNS = (
    "user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "transaction_id",
    "conversion_value_local", "conversion_value_usd", "path_length", "source", "medium", "campaign",
    "channel", "model", "attributed_credit", "attributed_value_usd", "attributed_value_local",
)
# ------------------------------------------------------------------------------
# 1 on one row of each (conversion, model, channel), and of each (conversion,
# model): sums of them count conversions without a distinct over the mart.
COUNT_COLUMNS = ("first_of_channel", "first_of_model")
_JOURNEY_KEEP = (
    "user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "transaction_id",
    "conversion_value_local", "conversion_value_usd", "path_length",
)


def decay_weight(hours: Column) -> Column:
    """Pipeline time decay, 7-day half-life: 2^(-h/168), uncapped."""
    return F.pow(F.lit(2.0), -hours.cast("double") / F.lit(HALF_LIFE_HOURS))


def standalone_decay_weight(hours: Column) -> Column:
    """Stand-alone time decay: exp(-0.00412 * min(h, 168))."""
    return F.exp(F.lit(-STANDALONE_DECAY_RATE) * F.least(hours, F.lit(STANDALONE_DECAY_CAP_HOURS)).cast("double"))


def last_non_direct_position(path: Column) -> Column:
    """1-based position of the last non-Direct touch; 0 if none."""
    idx = F.transform(path, lambda x, i: F.when(x["channel"] != F.lit("Direct"), i + 1).otherwise(0))
    return F.array_max(idx)


def u_shape_credit(n: Column, p: Column, q: Column) -> Column:
    return (F.when(n == 1, F.lit(1.0)).when(n == 2, F.lit(0.5))
            .when(p == 1, F.lit(0.4)).when(q == 1, F.lit(0.4))
            .otherwise(F.lit(0.2) / (n - 2).cast("double")))


def position_weighted_credit(n: Column, p: Column, q: Column) -> Column:
    return (F.when(n == 1, F.lit(1.0))
            .when((n == 2) & (p == 1), F.lit(0.6)).when((n == 2) & (q == 1), F.lit(0.4))
            .when(p == 1, F.lit(0.5)).when(q == 1, F.lit(0.3))
            .otherwise(F.lit(0.2) / (n - 2).cast("double")))


def _rnd(c: Column, cfg: AttributionConfig, digits: int = 4) -> Column:
    return F.round(c, digits) if cfg.round_credit else c


def model_credits(journeys_df: DataFrame, cfg: AttributionConfig, models=RULE_MODELS) -> DataFrame:
    """Long table: one row per (conversion, touchpoint, crediting model), with
    the two count columns."""
    unknown = set(models) - set(RULE_MODELS)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    path = F.col("path")
    j = journeys_df.select(
        *_JOURNEY_KEEP, "path",
        F.aggregate(path, F.lit(0.0), lambda acc, x: acc + decay_weight(x["hours_before_conversion"]))
        .alias("_decay_total"),
        last_non_direct_position(path).alias("_lnd"), F.col("path.channel").alias("_channels"),
    )
    t = j.select(*_JOURNEY_KEEP, "_decay_total", "_lnd", "_channels", F.posexplode(path).alias("_pos", "tp"))
    n = F.col("path_length")
    p = F.col("_pos") + 1
    q = n - F.col("_pos")
    lnd = F.when(F.col("_lnd") > 0, F.col("_lnd")).otherwise(n)
    one = F.lit(1.0)
    null = F.lit(None).cast("double")
    credit = {
        "first_click": F.when(p == 1, one).otherwise(null),
        "last_click": F.when(q == 1, one).otherwise(null),
        "last_non_direct_click": F.when(p == lnd, one).otherwise(null),
        "linear": _rnd(one / n.cast("double"), cfg),
        "time_decay": _rnd(decay_weight(F.col("tp.hours_before_conversion")) / F.col("_decay_total"), cfg),
        "u_shape": _rnd(u_shape_credit(n, p, q), cfg),
        "position_weighted": _rnd(position_weighted_credit(n, p, q), cfg),
    }
    # explode every (model, credit) pair and drop the non-crediting ones with a
    # plain Filter: unlike a higher-order filter() over the array, both the
    # generator and the predicate run inside whole-stage code generation
    single = ("first_click", "last_click", "last_non_direct_click")
    first_channel = F.array_position(F.col("_channels"), F.col("tp.channel")) == p
    arr = F.array(*[F.struct(
        F.lit(m).alias("model"), credit[m].alias("credit"),
        (F.lit(1) if m in single else first_channel.cast("int")).alias("first_of_channel"),
        (F.lit(1) if m in single else (p == 1).cast("int")).alias("first_of_model")) for m in models])
    e = t.select(*_JOURNEY_KEEP,
                 F.col("tp.source").alias("source"), F.col("tp.medium").alias("medium"),
                 F.col("tp.campaign").alias("campaign"), F.col("tp.channel").alias("channel"),
                 F.explode(arr).alias("mc")).where(F.col("mc.credit").isNotNull())
    return e.select(
        *_JOURNEY_KEEP, "source", "medium", "campaign", "channel",
        F.col("mc.model").alias("model"),
        F.col("mc.credit").alias("attributed_credit"),
        value_expr("conversion_event", "conversion_value_usd", F.col("mc.credit"), cfg).alias("attributed_value_usd"),
        value_expr("conversion_event", "conversion_value_local", F.col("mc.credit"), cfg).alias("attributed_value_local"),
        *[F.col(f"mc.{c}").alias(c) for c in COUNT_COLUMNS],
    ).select(*MART_COLUMNS, *COUNT_COLUMNS)


def single_model(journeys_df: DataFrame, cfg: AttributionConfig, model: str) -> DataFrame:
    """One model's fact table (the 16 shared columns)."""
    return model_credits(journeys_df, cfg, models=(model,)).select(*MART_COLUMNS)


def last_non_direct_click_full_outer(path_rows_df: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Literal form of the reference's last-non-direct model (filtered
    last-touch ⟗ last session, then COALESCE). Kept as a test oracle for
    the one-pass form; it costs two window sorts and a full outer join."""
    from pyspark.sql import Window
    w = Window.partitionBy("user_pseudo_id", "conversion_id").orderBy(F.col("session_position_asc").desc())
    keep = [c for c in MART_COLUMNS if c not in ("model", "attributed_credit", "attributed_value_usd",
                                                 "attributed_value_local")]
    lnd = (path_rows_df.where(F.col("channel") != "Direct")
           .withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*keep))
    ls = path_rows_df.where(F.col("session_position_desc") == 1).select(*keep)
    a, b = lnd.alias("a"), ls.alias("b")
    j = a.join(b, (F.col("a.user_pseudo_id") == F.col("b.user_pseudo_id"))
               & (F.col("a.conversion_id") == F.col("b.conversion_id")), "full")
    cols = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in keep]
    out = j.select(*cols).withColumn("model", F.lit("last_non_direct_click")) \
           .withColumn("attributed_credit", F.lit(1.0))
    return out.select(
        *keep, "model", "attributed_credit",
        value_expr("conversion_event", "conversion_value_usd", F.lit(1.0), cfg).alias("attributed_value_usd"),
        value_expr("conversion_event", "conversion_value_local", F.lit(1.0), cfg).alias("attributed_value_local"),
    )


def counted_mart(journeys_df: DataFrame, cfg: AttributionConfig, data_driven_df: DataFrame | None = None) -> DataFrame:
    """UNION ALL of the seven rule models (one pass) plus, when given, the
    data-driven model's fact rows, with the two count columns."""
    mart = model_credits(journeys_df, cfg)
    return mart.unionByName(data_driven_df) if data_driven_df is not None else mart


def attribution_mart(journeys_df: DataFrame, cfg: AttributionConfig, data_driven_df: DataFrame | None = None) -> DataFrame:
    """The mart proper: the 16 shared columns."""
    return counted_mart(journeys_df, cfg, data_driven_df).select(*MART_COLUMNS)


# ---- stand-alone model variants (channel-level reports) -----------------------

# --- fixed values (stand-alone display names, in the scripts' union order) -----
STANDALONE_MODEL_NAMES = {
    "last_click": "Last Click", "first_click": "First Click", "last_non_direct": "Last Non-Direct",
    "linear": "Linear", "time_decay": "Time Decay", "u_shape": "U-Shaped",
}
# ------------------------------------------------------------------------------


def standalone_weights(journeys_sa: DataFrame) -> DataFrame:
    """Per touchpoint of a stand-alone journey, the six unrounded weights."""
    path = F.col("path")
    j = journeys_sa.select(
        "user_pseudo_id", "conversion_id", "conversion_ts", "path_length", "path",
        F.aggregate(path, F.lit(0.0),
                    lambda acc, x: acc + standalone_decay_weight(x["hours_before_conversion"])).alias("_dt"),
        last_non_direct_position(path).alias("_lnd"),
    )
    t = j.select("user_pseudo_id", "conversion_id", "conversion_ts", "path_length", "_dt", "_lnd",
                 F.posexplode(path).alias("_pos", "tp"))
    n = F.col("path_length")
    p = F.col("_pos") + 1
    q = n - F.col("_pos")
    lnd = F.when(F.col("_lnd") > 0, F.col("_lnd")).otherwise(n)
    zero = F.lit(0.0)
    return t.select(
        "user_pseudo_id", "conversion_id", "conversion_ts", "path_length",
        F.col("tp.channel").alias("channel"),
        F.col("tp.hours_before_conversion").alias("hours_before"),
        p.cast("bigint").alias("pos_asc"), q.cast("bigint").alias("pos_desc"),
        F.when(q == 1, 1.0).otherwise(zero).alias("w_last_click"),
        F.when(p == 1, 1.0).otherwise(zero).alias("w_first_click"),
        F.when(p == lnd, 1.0).otherwise(zero).alias("w_last_non_direct"),
        (F.lit(1.0) / n.cast("double")).alias("w_linear"),
        F.try_divide(standalone_decay_weight(F.col("tp.hours_before_conversion")),
                     F.when(F.col("_dt") != 0, F.col("_dt"))).alias("w_time_decay"),
        u_shape_credit(n, p, q).alias("w_u_shape"),
    )


def attribution_mart_legacy(journeys_sa: DataFrame) -> DataFrame:
    """Stand-alone 6-model long table: user, conversion_ts, model, channel,
    attributed_conversions (unrounded weights, display model names)."""
    w = standalone_weights(journeys_sa)
    arr = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"w_{key}").alias("weight"),
                 (F.col(f"w_{key}") != 0).alias("hit") if key in ("last_click", "first_click", "last_non_direct")
                 else F.lit(True).alias("hit"))
        for key, name in STANDALONE_MODEL_NAMES.items()
    ])
    e = w.select("user_pseudo_id", "conversion_ts", "channel", F.explode(arr).alias("m")).where(F.col("m.hit"))
    return e.select("user_pseudo_id", "conversion_ts", F.col("m.model").alias("model"), "channel",
                    F.col("m.weight").alias("attributed_conversions"))
