"""Credits by channel without pairs of conversions and sessions.

How often each channel stands in a conversion's window is the difference of
two running counts, taken at the window's ends on the user's timeline
(``single_touch``). The counts, the first, the last and the last non-direct
channel and the path length fix the credits of all models but time decay: its
weights depend on each session's whole hours before the conversion, and every
session's share is rounded by itself. So

* a conversion of up to ``PAIRED`` sessions meets them in the lookback join;
* one of more takes the running counts at every whole hour of its window: as
  many rows as the window has hours, whatever the number of sessions.

A user with m conversions and n sessions costs m + n rows, and at most
``PAIRED`` or the window's hours (745) for each conversion on top.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MICROS_PER_DAY, MICROS_PER_HOUR, AttributionConfig
from ..functions.channels import FEATURE_CHANNELS
from ..functions.conversion import value_expr, value_mode_case
from ..functions.util import utc_date_from_micros
from .data_driven import DATA_DRIVEN_MODEL, FEATURES, LogisticModel, removal_shares
from .journeys import CONV_KEY, touchpoints
from .models import _rnd, decay_weight, position_weighted_credit, u_shape_credit
from .reports import with_variance
from .single_touch import timeline, touches

PAIRED = 1024
ENDS = {"u_shape": u_shape_credit, "position_weighted": position_weighted_credit}
_CONV = ("conversion_event", "conversion_us", "conversion_key", "lo", "purchase_revenue", "purchase_revenue_in_usd")


def channel_counts(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig,
                   store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A row for each conversion with a session in its window: user, the
    conversion's columns, path_length, the channels ``first``, ``last`` and
    ``last_non_direct``, and ``n_0`` ... by channel."""
    keep = store or (lambda df: df)
    hits = {f"n_{i}": F.col("touch.channel") == c for i, c in enumerate(FEATURE_CHANNELS)}
    t = touches(keep(timeline(sessions, conversions, cfg)), hits)
    return keep(t.select("user_pseudo_id", *[F.col(f"conv.{c}").alias(c) for c in _CONV], "path_length",
                         *[F.col(f"{c}.channel").alias(c) for c in ("first", "last", "last_non_direct")], *hits))


def _part(model: str, credit: Column, times: Column, hit: Column) -> Column:
    return F.struct(F.lit(model).alias("model"), credit.cast("double").alias("credit"), times.alias("times"), hit.alias("hit"))


def counted_credits(counts: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """event, time, values, model, channel, credit of one touch, times it is
    given, and ``hit`` (1 for each conversion, model and channel); time decay only
    with its hits. Conversions without a value (count mode) are counted by day,
    path length and the channel's places first: their rows stand for many, and
    their time is the start of the day."""
    n, one, zero = F.col("path_length"), F.lit(1.0), F.lit(0).cast("long")
    seen = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"n_{i}").alias("k")) for i, c in enumerate(FEATURE_CHANNELS)])).alias("x")
    at = [(F.col(c) == F.col("x.channel")).cast("long").alias(c) for c in ("first", "last", "last_non_direct")]
    e = counts.select(*_OUT[:4], "path_length", "first", "last", "last_non_direct", seen).where(F.col("x.k") > 0)
    e = e.select(*_OUT[:4], "path_length", "x.channel", "x.k", *at)
    counted = value_mode_case("conversion_event", cfg) == "count"
    key = ["conversion_event", "conversion_us", "path_length", "channel", "k", "first", "last", "last_non_direct"]
    day = F.floor(F.col("conversion_us") / F.lit(MICROS_PER_DAY)) * F.lit(MICROS_PER_DAY)
    many = e.where(counted).withColumn("conversion_us", day).groupBy(*key).agg(F.count(F.lit(1)).alias("w"))
    e = e.where(~counted).withColumn("w", F.lit(1).cast("long")).unionByName(many, allowMissingColumns=True)
    # a place's credit, by the models' own rules: first, last, or between (any place but the ends)
    place = lambda rule, p: _rnd(rule(n, p, n - p + 1), cfg)
    k, w, first, last_non_direct = (F.col(c) for c in ("k", "w", "first", "last_non_direct"))
    last = F.when(n > 1, F.col("last")).otherwise(zero)
    parts = [_part("linear", _rnd(one / n.cast("double"), cfg), k * w, w), _part("time_decay", F.lit(0.0), zero, w)]
    for m, rule in ENDS.items():
        parts += [_part(m, F.when(n > 2, place(rule, n - n + 2)).otherwise(0.0), (k - first - last) * w, w),
                  _part(m, place(rule, F.lit(1)), first * w, zero), _part(m, place(rule, n), last * w, zero)]
    parts += [_part(m, one, x * w, x * w) for m, x in (("first_click", first), ("last_click", F.col("last")), ("last_non_direct_click", last_non_direct))]
    out = e.select(*_OUT[:4], "channel", F.explode(F.array(*parts)).alias("x")).where((F.col("x.times") > 0) | (F.col("x.hit") > 0))
    return out.select(*_OUT[:4], "x.model", "channel", "x.credit", "x.times", "x.hit")


_OUT = ("conversion_event", "conversion_us", "purchase_revenue", "purchase_revenue_in_usd", "model", "channel", "credit", "times", "hit")


def _decayed(cells: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """cells: conversions with an array of (hours, channel, k) -> credit rows of time decay."""
    total = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + x["k"].cast("double") * decay_weight(x["hours"]))
    e = cells.withColumn("_total", total).select(*_OUT[:4], "_total", F.explode("cells").alias("x"))
    return e.select(*_OUT[:4], F.lit("time_decay").alias("model"), F.col("x.channel").alias("channel"),
                    _rnd(decay_weight(F.col("x.hours")) / F.col("_total"), cfg).alias("credit"), F.col("x.k").alias("times"), F.lit(0).alias("hit"))


def paired_decay(sessions: DataFrame, counts: DataFrame, cfg: AttributionConfig, most: int = PAIRED) -> DataFrame:
    """Time decay of the conversions with up to ``most`` sessions, by the lookback join."""
    few = counts.where(F.col("path_length") <= most)
    # the join gives each pair as (hours, channel); a conversion gathers at most ``most`` of them
    tp = touchpoints(sessions, few, cfg, ("channel",), carry=_OUT[2:4])
    return _decayed(tp.groupBy(*CONV_KEY, *_OUT[2:4]).agg(F.collect_list(F.struct(
        F.col("hours_before_conversion").alias("hours"), "channel", F.lit(1).cast("long").alias("k"))).alias("cells")), cfg)


def hourly_decay(sessions: DataFrame, counts: DataFrame, cfg: AttributionConfig, most: int = PAIRED) -> DataFrame:
    """Time decay of the conversions with more sessions: those at each whole
    number of hours before it are the difference of two running counts."""
    hour = F.lit(MICROS_PER_HOUR)
    many = counts.where(F.col("path_length") > most)
    key = [*CONV_KEY, *_OUT[2:4]]
    steps = F.floor((F.col("conversion_us") - F.col("lo")) / hour) + 1
    points = many.select(*key, "lo", F.explode(F.sequence(F.lit(0).cast("long"), steps)).alias("hours"))
    points = points.select("user_pseudo_id", F.struct(*key[1:]).alias("conv"), "hours", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("channel"),
                           F.greatest(F.col("conversion_us") - F.col("hours") * hour, F.col("lo") - 1).alias("t"))
    users = many.select("user_pseudo_id").distinct()
    s = sessions.join(users, "user_pseudo_id", "left_semi").select("user_pseudo_id", F.col("session_start_us").alias("t"), F.lit(0).alias("kind"), "channel")
    line = s.unionByName(points, allowMissingColumns=True).withColumn("bucket", F.floor(F.col("t") / F.lit(MICROS_PER_DAY)))
    upto = Window.partitionBy("user_pseudo_id", "bucket").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    hits = {f"n_{i}": F.count(F.when(F.col("channel") == c, 1)) for i, c in enumerate(FEATURE_CHANNELS)}
    inside = line.select("user_pseudo_id", "bucket", "kind", "conv", "hours", *[h.over(upto).alias(n) for n, h in hits.items()]).where("kind = 1")
    before = Window.partitionBy("user_pseudo_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = line.groupBy("user_pseudo_id", "bucket").agg(*[h.alias(n) for n, h in hits.items()])
    carried = ends.select("user_pseudo_id", "bucket", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"c_{n}") for n in hits])
    so_far = F.array(*[F.col(n) + F.col(f"c_{n}") for n in hits])
    grid = inside.join(carried, ["user_pseudo_id", "bucket"]).groupBy("user_pseudo_id", "conv").agg(
        F.array_sort(F.collect_list(F.struct("hours", so_far.alias("n")))).alias("grid"))
    names = F.array(*[F.lit(c) for c in FEATURE_CHANNELS])
    cells = F.flatten(F.transform(F.slice("grid", 1, F.size("grid") - 1), lambda g: F.filter(
        F.transform(names, lambda c, i: F.struct(g["hours"].alias("hours"), c.alias("channel"), (
            F.element_at(g["n"], i + 1) - F.element_at(F.element_at(F.col("grid"), (g["hours"] + 2).cast("int"))["n"], i + 1)).alias("k"))), lambda x: x["k"] > 0)))
    return _decayed(grid.select("user_pseudo_id", "conv.*", cells.alias("cells")), cfg)


def data_driven_credits(counts: DataFrame, model: LogisticModel) -> DataFrame:
    """Removal effects from the channels that were seen."""
    flags = [(F.col(f"n_{i}") > 0).cast("int").alias(f) for i, f in enumerate(FEATURES)]
    e, credit = removal_shares(counts.select(*_OUT[:4], *flags), model)
    return e.select(*_OUT[:4], F.lit(DATA_DRIVEN_MODEL).alias("model"), F.col("_e.channel").alias("channel"), credit.alias("credit"),
                    F.lit(1).cast("long").alias("times"), F.lit(1).alias("hit"))


def channel_credits(sessions: DataFrame, conversions: DataFrame, cfg: AttributionConfig, model: LogisticModel | None = None,
                    store: Callable[[DataFrame], DataFrame] | None = None, most: int = PAIRED) -> DataFrame:
    """Credit rows of the seven rule models, and of the data-driven one with
    ``model``: the mart's touches by conversion and channel, with equal ones counted."""
    counts = channel_counts(sessions, conversions, cfg, store)
    out = counted_credits(counts, cfg).unionByName(paired_decay(sessions, counts, cfg, most))
    if not counts.where(F.col("path_length") > most).isEmpty():  # else there is nothing to look up by hours
        out = out.unionByName(hourly_decay(sessions, counts, cfg, most))
    return out.unionByName(data_driven_credits(counts, model)) if model is not None else out


def _totals(credits: DataFrame, cfg: AttributionConfig, *by) -> DataFrame:
    """Conversions, and exact sums of credits and values, of model, event, value mode and channel."""
    times = F.col("times").cast("decimal(13,0)")  # with a value of 24 digits 38 in all
    total = lambda c: F.sum(c.cast("decimal(24,10)") * times)
    value = lambda c: value_expr("conversion_event", c, F.col("credit"), cfg)
    return credits.groupBy(*by, "model", "conversion_event", value_mode_case("conversion_event", cfg).alias("value_mode"), "channel").agg(
        F.sum("hit").alias("attributed_conversions"), total(F.col("credit")).alias("_credit"),
        total(value("purchase_revenue_in_usd")).alias("_usd"), total(value("purchase_revenue")).alias("_local"))


def cross_channel(credits: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """The report of ``reports.cross_channel``, from credit rows."""
    return with_variance(_totals(credits, cfg))


def daily_totals(credits: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Exact totals by day: a small table that the report and ROAS both read."""
    return _totals(credits, cfg, utc_date_from_micros("conversion_us").alias("date"))


def cross_channel_of_days(totals: DataFrame) -> DataFrame:
    """The report from ``daily_totals`` (a conversion has one date)."""
    return with_variance(totals.groupBy("model", "conversion_event", "value_mode", "channel").agg(
        *[F.sum(c).alias(c) for c in ("attributed_conversions", "_credit", "_usd", "_local")]))


def attribution_daily(credits: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """The totals of ``cost.attribution_daily``, from credit rows."""
    return daily_totals(credits, cfg).withColumnRenamed("_usd", "_value").drop("_local")
