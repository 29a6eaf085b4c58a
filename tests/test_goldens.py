"""Hand-written edge cases (FIXTURES.md §4) on tiny event tables."""

import pytest
from pyspark.sql import functions as F

from conftest import conversion_event, make_events, session_event, us
from tributary.config import MICROS_PER_DAY, AttributionConfig, ConversionEvent
from tributary.operators import cost as cost_ops
from tributary.operators import data_driven as dd
from tributary.operators import models, reports
from tributary.operators.conversions import conversions
from tributary.operators.journeys import journeys, path_rows
from tributary.operators.sessions import sessions
from tributary.sources.cost import COST_SCHEMA

CFG = AttributionConfig(start_date="20240110", end_date="20240131")


def run(spark, rows, cfg=CFG):
    ev = make_events(spark, rows)
    s, c = sessions(ev, cfg), conversions(ev, cfg)
    return s, c, journeys(s, c, cfg)


def path_of(n, user="u", direct=False, conv_ts=None):
    """n daily sessions before a purchase on Jan 20 12:00 (n <= 10 stays in
    the 30-day window; longer paths use hourly sessions)."""
    conv_ts = conv_ts or us(2024, 1, 20, 12)
    rows = []
    for i in range(n):
        ts = conv_ts - (n - i) * 3_600_000_000
        src, med = (None, None) if direct else ("google", "organic" if i % 2 else "cpc")
        rows.append(session_event(user, 1000 + i, ts, src, med, "generic"))
    rows.append(conversion_event(user, conv_ts, usd=100.0, local=90.0, tid="T1", sid=1000 + n - 1))
    return rows


def credits(mart, model):
    return [r.attributed_credit for r in mart.where(F.col("model") == model).orderBy("source", "medium")
            .select("attributed_credit").collect()]


@pytest.mark.parametrize("n,expected_sum", [(1, 1.0), (2, 1.0), (3, 0.9999), (60, 1.002)])
def test_linear_rounding_drift(spark, n, expected_sum):
    _, _, j = run(spark, path_of(n))
    mart = models.attribution_mart(j, CFG)
    s = mart.where("model = 'linear'").agg(F.sum(F.col("attributed_credit").cast("decimal(20,4)"))).first()[0]
    assert float(s) == pytest.approx(expected_sum, abs=1e-9)
    assert mart.where("model = 'first_click'").count() == 1
    assert mart.where("model = 'last_click'").count() == 1


def test_position_models_small_paths(spark):
    _, _, j = run(spark, path_of(2))
    pr = path_rows(j).orderBy("session_position_asc").collect()
    mart = models.attribution_mart(j, CFG)
    u = {r.session_id: r.attributed_credit for r in mart.where("model = 'u_shape'").join(
        path_rows(j).select("conversion_id", "channel", "session_id"), ["conversion_id", "channel"]).collect()}
    assert sorted(u.values()) == [0.5, 0.5]
    pw = mart.where("model = 'position_weighted'").orderBy("attributed_credit").collect()
    assert [r.attributed_credit for r in pw] == [0.4, 0.6]
    assert pw[1].channel == pr[0].channel  # first touch gets 0.6
    _, _, j3 = run(spark, path_of(5))
    m5 = models.attribution_mart(j3, CFG)
    assert sorted(credits(m5, "u_shape")) == [0.0667, 0.0667, 0.0667, 0.4, 0.4]
    assert sorted(credits(m5, "position_weighted")) == [0.0667, 0.0667, 0.0667, 0.3, 0.5]


def test_all_direct_falls_back_to_last_session(spark):
    _, _, j = run(spark, path_of(3, direct=True))
    lnd = models.single_model(j, CFG, "last_non_direct_click").collect()
    assert len(lnd) == 1 and lnd[0].channel == "Direct"
    lit = models.last_non_direct_click_full_outer(path_rows(j), CFG).collect()
    assert [(r.conversion_id, r.channel) for r in lit] == [(lnd[0].conversion_id, "Direct")]


def test_last_non_direct_skips_trailing_direct(spark):
    c = us(2024, 1, 20, 12)
    rows = [session_event("u", 1, c - 3 * 3_600_000_000, "news", "email"),
            session_event("u", 2, c - 2 * 3_600_000_000),
            session_event("u", 3, c - 1 * 3_600_000_000),
            conversion_event("u", c, usd=10.0, local=9.0, tid="T")]
    _, _, j = run(spark, rows)
    assert models.single_model(j, CFG, "last_non_direct_click").first().channel == "Email"
    assert models.single_model(j, CFG, "last_click").first().channel == "Direct"


def test_session_at_conversion_time_included(spark):
    c = us(2024, 1, 20, 12)
    _, _, j = run(spark, [session_event("u", 1, c, "google", "organic"),
                          conversion_event("u", c, usd=5.0, local=4.5, tid="T")])
    pr = path_rows(j).collect()
    assert len(pr) == 1 and pr[0].hours_before_conversion == 0


@pytest.mark.parametrize("event,lookback", [("purchase", 30), ("add_to_cart", 7)])
def test_lookback_edge_whole_days(spark, event, lookback):
    c = us(2024, 1, 25, 12)
    inside = c - lookback * MICROS_PER_DAY - (MICROS_PER_DAY - 1_000_000)  # L days 23:59:59 before
    outside = c - (lookback + 1) * MICROS_PER_DAY  # exactly L+1 days before
    rows = [session_event("u", 1, inside, "google", "organic"), session_event("u", 2, outside, "news", "email"),
            conversion_event("u", c, name=event, tid="T")]
    _, _, j = run(spark, rows)
    pr = path_rows(j).collect()
    assert [r.session_id for r in pr] == [1]


def test_exact_lookback_mode(spark):
    c = us(2024, 1, 25, 12)
    rows = [session_event("u", 1, c - 30 * MICROS_PER_DAY, "google", "organic"),
            session_event("u", 2, c - 30 * MICROS_PER_DAY - 1, "news", "email"),
            conversion_event("u", c, tid="T")]
    _, _, j = run(spark, rows, CFG.with_(lookback_mode="exact"))
    assert [r.session_id for r in path_rows(j).collect()] == [1]


def test_conversion_without_session_vanishes(spark):
    c = us(2024, 1, 20, 12)
    s, conv, j = run(spark, [conversion_event("u", c, tid="T"),
                             session_event("v", 1, c - 3_600_000_000, "google", "organic"),
                             conversion_event("v", c, tid="T2")])
    assert conv.count() == 2
    assert [r.user_pseudo_id for r in j.collect()] == ["v"]


def test_duplicate_conversion_keeps_highest_revenue(spark):
    c = us(2024, 1, 20, 12)
    rows = [conversion_event("u", c, usd=50.0, local=45.0, tid="T"),
            conversion_event("u", c, usd=49.0, local=44.1, tid="T"),
            conversion_event("u", c, usd=None, local=None, tid="T")]
    conv = conversions(make_events(spark, rows), CFG).collect()
    assert len(conv) == 1 and conv[0].purchase_revenue == 45.0 and conv[0].purchase_revenue_in_usd == 50.0


def test_null_transaction_same_ts_and_event_keeps_one(spark):
    c = us(2024, 1, 20, 12)
    rows = [conversion_event("u", c, name="add_to_cart"), conversion_event("u", c, name="add_to_cart"),
            conversion_event("u", c, name="begin_checkout")]
    conv = conversions(make_events(spark, rows), CFG)
    assert conv.count() == 2


def test_end_date_midnight_cutoff(spark):
    rows = [conversion_event("u", us(2024, 1, 31, 0, 0, 0), tid="A"),
            conversion_event("u", us(2024, 1, 31, 0, 0, 1), tid="B")]
    ev = make_events(spark, rows)
    assert [r.transaction_id for r in conversions(ev, CFG).collect()] == ["A"]
    assert conversions(ev, CFG.with_(end_inclusive=True)).count() == 2


def test_count_and_fixed_value_modes(spark):
    cfg = CFG.with_(conversion_events=(ConversionEvent("purchase", "revenue", lookback_days=30),
                                       ConversionEvent("add_to_cart", "count", lookback_days=7),
                                       ConversionEvent("generate_lead", "fixed", fixed_value_usd=50.0,
                                                       lookback_days=7)))
    c = us(2024, 1, 20, 12)
    rows = [session_event("u", 1, c - 3_600_000_000, "google", "organic"),
            session_event("u", 2, c - 1_800_000_000, "news", "email"),
            conversion_event("u", c, name="add_to_cart"), conversion_event("u", c, name="generate_lead")]
    _, _, j = run(spark, rows, cfg)
    mart = models.attribution_mart(j, cfg)
    cnt = mart.where("conversion_event = 'add_to_cart'").collect()
    assert all(r.attributed_value_usd is None for r in cnt) and all(r.attributed_credit is not None for r in cnt)
    for r in mart.where("conversion_event = 'generate_lead'").collect():
        assert r.attributed_value_usd == pytest.approx(50.0 * r.attributed_credit)


def test_all_zero_effects_give_one_nineteenth(spark):
    _, _, j = run(spark, path_of(2))
    flat = dd.LogisticModel(0.3, tuple(0.0 for _ in dd.FEATURES))
    out = dd.data_driven(j, flat, CFG).collect()
    assert len(out) == 19
    assert {r.attributed_credit for r in out} == {round(1 / 19, 6)}


def test_cart_then_purchase_in_other_session_is_abandoned(spark):
    c = us(2024, 1, 20, 12)
    rows = [conversion_event("u", c, name="add_to_cart", sid=1),
            conversion_event("u", c + 7_200_000_000, name="purchase", sid=2, tid="T", usd=5.0, local=4.5)]
    conv = conversions(make_events(spark, rows), CFG)
    sess_scoped = reports.cart_abandonment(conv).first()
    assert sess_scoped.users_with_cart == 1 and sess_scoped.users_converted == 0
    assert sess_scoped.abandonment_rate_pct == 100.0
    user_scoped = reports.cart_abandonment(conv, user_scoped=True).first()
    assert user_scoped.users_converted == 1 and user_scoped.abandonment_rate_pct == 0.0


def _cost(spark, rows):
    return spark.createDataFrame(rows, COST_SCHEMA)


def test_organic_channel_in_roas_has_no_cost(spark):
    from datetime import date
    c = us(2024, 1, 20, 12)
    rows = [session_event("u", 1, c - 3_600_000_000, "google", "organic"),
            conversion_event("u", c, usd=100.0, local=90.0, tid="T")]
    _, _, j = run(spark, rows)
    mart = models.counted_mart(j, CFG)
    cost = _cost(spark, [(date(2024, 1, 20), "Paid Social", "c", 10.0, 100, 7, "meta_ads")])
    r = cost_ops.roas(cost_ops.attribution_daily(mart, CFG), cost_ops.unified_cost(cost)).where("model = 'last_click'").first()
    assert r.channel == "Organic Search" and r.cost_usd is None and r.roas is None and r.cpa is None
    assert r.rpc == 100.0


def test_two_platforms_on_one_channel(spark):
    from datetime import date
    d = date(2024, 1, 20)
    g = _cost(spark, [(d, "Paid Social", "spring", 10.0, 100, 7, "meta_ads")])
    o = _cost(spark, [(d, "Paid Social", "spring", 5.5, 50, 3, "tiktok")])
    u = cost_ops.unified_cost(g, o).first()
    assert u.cost_usd == 15.5 and u.impressions == 150 and u.clicks == 10
    assert u.source_systems == "meta_ads, tiktok"
    assert u.ctr == round(10 / 150, 4) and u.cpc == round(15.5 / 10, 2)


def test_unified_cost_null_guard_on_every_arm(spark):
    from datetime import date
    a = _cost(spark, [(None, "Display", "x", 1.0, 1, 1, "google_ads")])
    b = _cost(spark, [(date(2024, 1, 2), "Display", "x", 2.0, 1, 1, "linkedin"), (None, "Display", "x", 9.0, 1, 1, "linkedin")])
    rows = cost_ops.unified_cost(a, b).collect()
    assert [(r.cost_usd, r.source_systems) for r in rows] == [(2.0, "linkedin")]
