"""Credits from running counts against credits from paths."""

import random

import pytest

from conftest import SF_SMALL, conversion_event, make_events, session_event, us
from tributary.config import AttributionConfig
from tributary.operators import channel_credits as C
from tributary.operators.conversions import conversions
from tributary.operators.cost import attribution_daily
from tributary.operators.data_driven import LogisticModel
from tributary.operators.reports import cross_channel
from tributary.plans.catalog import STATED_INTERCEPT, STATED_WEIGHTS, pipe
from tributary.plans.pipeline import Pipeline

CFG = AttributionConfig(start_date="20240101", end_date="20240228")
TRAFFIC = [("google", "organic"), ("news", "email"), (None, None), ("x", "social"), ("crm", "sms"), ("g", "cpc"), ("blog", "referral")]
HOUR = 3_600_000_000


def busy_events(seed, users=6, sessions=40, convs=25):
    """Users with few and many sessions; ties at window ends, whole hours and equal instants."""
    rng = random.Random(seed)
    ev = []
    for u in range(users):
        base = us(2024, 1, 20)
        times = [base + rng.randrange(0, 30 * 24) * HOUR + rng.choice([0, 0, 1, -1, rng.randrange(HOUR)]) for _ in range(sessions if u else 3)]
        for i, t in enumerate(times):
            s, m = TRAFFIC[0] if u == 1 else rng.choice(TRAFFIC)
            ev.append(session_event(f"u{u}", i, t, s, m))
        for i in range(convs):
            t = rng.choice(times) + rng.choice([0, HOUR, 7 * 24 * HOUR, 8 * 24 * HOUR, 8 * 24 * HOUR - 1, rng.randrange(20 * 24 * HOUR)])
            name = rng.choice(["purchase", "add_to_cart", "begin_checkout"])
            ev.append(conversion_event(f"u{u}", t, name, usd=10.0 + i, local=9.0, tid=f"T{u}-{i}" if name == "purchase" else None))
    return ev


def report(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("most", [0, 4, 12, 1024])
def test_credits_by_counts_equal_credits_by_paths(spark, most):
    p = Pipeline(make_events(spark, busy_events(3)), CFG)
    p.dd_model = LogisticModel(STATED_INTERCEPT, STATED_WEIGHTS)
    want = report(cross_channel(p.counted, p.cfg))
    credits = C.channel_credits(p.sessions, p.conversions, p.cfg, p.dd_model, p._store(f"x{most}"), most)
    assert report(C.cross_channel(credits, p.cfg)) == want and len(want) > 100
    assert report(C.cross_channel_of_days(C.daily_totals(credits, p.cfg))) == want
    assert report(C.attribution_daily(credits, p.cfg)) == report(attribution_daily(p.counted, p.cfg))
    p.cleanup()


def test_unrounded_credits_and_exact_lookback(spark):
    cfg = CFG.with_(round_credit=False, lookback_mode="exact")
    p = Pipeline(make_events(spark, busy_events(8, users=3)), cfg)
    p.dd_model = LogisticModel(STATED_INTERCEPT, STATED_WEIGHTS)
    want = {r[:4]: r[4:] for r in cross_channel(p.counted, cfg).select("model", "conversion_event", "channel", "attributed_conversions", "total_credit").collect()}
    got = C.cross_channel(C.channel_credits(p.sessions, p.conversions, cfg, p.dd_model, p._store("y"), 5), cfg)
    got = {r[:4]: r[4:] for r in got.select("model", "conversion_event", "channel", "attributed_conversions", "total_credit").collect()}
    assert got.keys() == want.keys() and all(got[k][0] == pytest.approx(want[k][0], abs=2e-6) for k in want)
    p.cleanup()


def test_no_pair_join_and_no_path_but_for_short_journeys(spark):
    p = pipe(spark, SF_SMALL)
    counts = C.channel_counts(p.sessions, p.conversions, p.cfg)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "_sb" not in plan and "collect_list" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    decay = C.hourly_decay(p.sessions, p._store("counts-plan")(counts), p.cfg)
    assert "_sb" not in decay._jdf.queryExecution().executedPlan().toString()


def test_a_user_with_very_many_sessions_and_conversions(spark):
    """4,000 sessions by 4,000 conversions in ten days, 16 million pairs."""
    from pyspark.sql import functions as F
    t0 = us(2024, 1, 20)
    base = spark.range(4000)
    ten_days = 10 * 24 * HOUR
    s = base.select(F.lit("bot").alias("user_pseudo_id"), F.col("id").alias("session_id"), (F.lit(t0) + F.col("id") * (ten_days // 4000)).alias("event_timestamp"),
                    F.lit("page_view").alias("event_name"), F.when(F.col("id") % 3 == 0, "google").otherwise("news").alias("source"),
                    F.when(F.col("id") % 3 == 0, "organic").otherwise("email").alias("medium"))
    c = base.select(F.lit("bot").alias("user_pseudo_id"), (F.lit(t0 + ten_days) + F.col("id") * 1_000_000).alias("event_timestamp"), F.lit("add_to_cart").alias("event_name"))
    empty = make_events(spark, [])
    ev = empty.unionByName(s.unionByName(c, allowMissingColumns=True).withColumn("event_date", F.from_unixtime(F.col("event_timestamp") / 1_000_000, "yyyyMMdd")),
                           allowMissingColumns=True)
    p = Pipeline(ev, CFG)
    got = C.cross_channel(C.channel_credits(p.sessions, conversions(p.scanned, CFG), CFG, None, p._store("bot")), CFG).collect()
    by = {(r.model, r.channel): r for r in got}
    assert {m for m, _ in by} == {"first_click", "last_click", "last_non_direct_click", "linear", "time_decay", "u_shape", "position_weighted"}
    assert all(r.attributed_conversions in (4000, r.total_credit) for r in got)
    total = by["linear", "Email"].total_credit + by["linear", "Organic Search"].total_credit
    assert 0.8 * 4000 < total < 1.2 * 4000 and by["linear", "Email"].total_credit == pytest.approx(2 * by["linear", "Organic Search"].total_credit, rel=0.01)
    p.cleanup()


def test_no_window_is_computed_anew_for_each_row(spark):
    """A frame up to the end of its rows costs their square: a user's busy day."""
    from tributary.operators.single_touch import timeline, touches
    p = Pipeline(make_events(spark, busy_events(4, users=2)), CFG)
    plan = touches(timeline(p.sessions, p.conversions, p.cfg))._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding$()" in plan and "unboundedfollowing$()" not in plan


def test_conversions_without_value_are_counted_before_they_are_credited(spark):
    """Equal conversions of a day, not worth anything themselves, share their credit rows."""
    t = us(2024, 1, 20)
    ev = [e for u in range(300) for e in (session_event(f"u{u}", 1, t, "google", "organic"), conversion_event(f"u{u}", t + u + 1, "add_to_cart"))]
    p = Pipeline(make_events(spark, ev), CFG)
    e = C.counted_credits(C.channel_counts(p.sessions, p.conversions, p.cfg), p.cfg)
    assert {(r.model, r.times, r.hit) for r in e.collect()} >= {("linear", 300, 300), ("last_click", 300, 300), ("time_decay", 0, 300)}
    assert e.count() <= 10
