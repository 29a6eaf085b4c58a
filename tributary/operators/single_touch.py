"""Single-touch models in time order, without pairs of conversions and sessions.

A conversion needs the first session at or after its window's start, the last
one (and the last non-direct one) at or before itself, and how many sessions
lie between. A user's sessions, window starts and conversions are put on one
timeline, cut into day buckets: a window function answers inside a bucket, and
one row per bucket carries the answers over bucket ends. The work is linear
in sessions plus conversions, and a task holds a bucket, not a user.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MICROS_PER_DAY, AttributionConfig
from ..functions.conversion import lookback_case, value_expr
from ..plans.joins import row_number_within
from .journeys import CONV_KEY, lookback_lower_bound
from .models import MART_COLUMNS

SINGLE_TOUCH_MODELS = ("first_click", "last_click", "last_non_direct_click")
_START, _SESSION, _CONVERSION = 0, 1, 2  # order of rows of the same instant


def timeline(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """user, t, kind, tie, touch (sessions), conv (window starts and conversions), bucket."""
    touch = F.struct("session_start_us", "session_id", "source", "medium", "campaign", "channel")
    c = conversions.withColumn("_lb", lookback_case(F.col("conversion_event"), cfg).cast("long"))
    c = c.withColumn("lo", lookback_lower_bound(F.col("conversion_us"), F.col("_lb"), cfg))
    conv = F.struct(*CONV_KEY[1:], "lo", "conversion_ts", "transaction_id", "purchase_revenue", "purchase_revenue_in_usd")
    c = c.select("user_pseudo_id", conv.alias("conv"), F.explode(F.array(
        F.struct(F.col("lo").alias("t"), F.lit(_START).alias("kind")),
        F.struct(F.col("conversion_us").alias("t"), F.lit(_CONVERSION).alias("kind")))).alias("x"))
    c = c.select("user_pseudo_id", "x.t", "x.kind", F.lit(None).cast("long").alias("tie"), "conv")
    s = sessions.select("user_pseudo_id", F.col("session_start_us").alias("t"), F.lit(_SESSION).alias("kind"),
                        F.col("session_id").alias("tie"), touch.alias("touch"))
    return s.unionByName(c, allowMissingColumns=True).withColumn("bucket", F.floor(F.col("t") / F.lit(MICROS_PER_DAY)))


def touches(line: DataFrame, hits: dict[str, Column] | None = None) -> DataFrame:
    """user, conv, path_length (> 0), first, last, last_non_direct; with
    ``hits`` also, by name, how many sessions of the window meet a condition.
    ``line`` is read twice: hand in a stored one."""
    counts = {n: F.count(F.when(c, 1)) for n, c in (hits or {}).items()}
    non_direct = F.when(F.col("touch.channel") != "Direct", F.col("touch"))
    count = F.count("touch")
    here = Window.partitionBy("user_pseudo_id", "bucket")
    # what lies ahead is what has passed in the reverse order: a frame that ends at
    # unbounded following is computed anew for each row
    back = here.orderBy("t", "kind", "tie").rowsBetween(Window.unboundedPreceding, 0)
    ahead = here.orderBy(*[F.col(c).desc() for c in ("t", "kind", "tie")]).rowsBetween(Window.unboundedPreceding, 0)
    inside = line.select(
        "user_pseudo_id", "bucket", "kind", "conv", count.over(back).alias("n"), F.last("touch", True).over(back).alias("last"),
        F.last(non_direct, True).over(back).alias("last_nd"), F.last("touch", True).over(ahead).alias("next"),
        *[c.over(back).alias(n) for n, c in counts.items()]
    ).where(F.col("kind") != _SESSION)
    ends = line.groupBy("user_pseudo_id", "bucket").agg(
        count.alias("n"), F.min("touch").alias("next"), F.max("touch").alias("last"), F.max(non_direct).alias("last_nd"),
        *[c.alias(n) for n, c in counts.items()])
    days = Window.partitionBy("user_pseudo_id")  # one row for each active day of the user
    before = days.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = days.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        "user_pseudo_id", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("c_n"), F.last("last", True).over(before).alias("c_last"),
        F.last("last_nd", True).over(before).alias("c_nd"), F.last("next", True).over(after).alias("c_next"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"c_{n}") for n in counts])
    j = inside.join(carry, ["user_pseudo_id", "bucket"])
    upto, start = F.col("kind") == _CONVERSION, F.col("kind") == _START
    total = F.col("n") + F.col("c_n")
    out = j.groupBy("user_pseudo_id", "conv").agg(
        F.max(F.when(upto, total)).alias("_upto"), F.max(F.when(start, total)).alias("_before"),
        F.max(F.when(upto, F.coalesce("last", "c_last"))).alias("last"), F.max(F.when(upto, F.coalesce("last_nd", "c_nd"))).alias("last_nd"),
        F.max(F.when(start, F.coalesce("next", "c_next"))).alias("first"),
        *[F.sum(F.when(upto, 1).otherwise(-1) * (F.col(n) + F.col(f"c_{n}"))).alias(n) for n in counts])
    out = out.withColumn("path_length", F.col("_upto") - F.col("_before")).where(F.col("path_length") > 0)
    in_window = F.col("last_nd.session_start_us") >= F.col("conv.lo")
    return out.select("user_pseudo_id", "conv", "path_length", "first", "last",
                      F.when(in_window, F.col("last_nd")).otherwise(F.col("last")).alias("last_non_direct"), *counts)


def single_touch(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig, models=SINGLE_TOUCH_MODELS,
                 store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Fact rows (the 16 shared columns) of the single-touch models."""
    unknown = set(models) - set(SINGLE_TOUCH_MODELS)
    if unknown:
        raise ValueError(f"not single-touch: {sorted(unknown)}")
    keep = store or (lambda df: df)
    t = keep(touches(keep(timeline(sessions, conversions, cfg))).select("user_pseudo_id", "conv.*", "path_length", "first", "last", "last_non_direct"))
    j = row_number_within(
        t, "user_pseudo_id", F.floor(F.col("conversion_us") / F.lit(cfg.number_bucket_micros)),
        ["conversion_us", "conversion_event", F.coalesce(F.col("transaction_id"), F.lit(""))], "seq")
    pick = {"first_click": "first", "last_click": "last", "last_non_direct_click": "last_non_direct"}
    arms = F.array(*[F.struct(F.lit(m).alias("model"), F.col(pick[m]).alias("tp")) for m in models])
    e = j.select("user_pseudo_id", F.concat("user_pseudo_id", F.lit("-"), F.col("seq").cast("string")).alias("conversion_id"), "conversion_ts",
                 "conversion_event", "transaction_id", F.col("purchase_revenue").alias("conversion_value_local"),
                 F.col("purchase_revenue_in_usd").alias("conversion_value_usd"), "path_length", F.explode(arms).alias("m"))
    one = F.lit(1.0)
    return e.select("*", *[F.col(f"m.tp.{c}").alias(c) for c in ("source", "medium", "campaign", "channel")], F.col("m.model").alias("model"),
                    one.alias("attributed_credit"),
                    value_expr("conversion_event", "conversion_value_usd", one, cfg).alias("attributed_value_usd"),
                    value_expr("conversion_event", "conversion_value_local", one, cfg).alias("attributed_value_local")).select(*MART_COLUMNS)
