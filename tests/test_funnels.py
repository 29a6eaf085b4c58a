"""Funnels: distinct counts without Expand, and stored days."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, conversion_event, make_events, us
from tributary.config import AttributionConfig
from tributary.operators.conversions import conversions
from tributary.operators.day_sets import add_days, funnel_of_days
from tributary.operators.reports import cart_abandonment, purchase_funnel
from tributary.plans.catalog import pipe
from tributary.streaming.tables import read_table

CFG = AttributionConfig(start_date="20240110", end_date="20240131", end_inclusive=True)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [purchase_funnel, lambda c: purchase_funnel(c, qualified=True), cart_abandonment, lambda c: cart_abandonment(c, user_scoped=True)])
def test_funnels_have_no_expand_and_scan_once(spark, build):
    p = pipe(spark, SF_SMALL)
    plan = plan_of(build(p._store("funnel-plan")(p.conversions)))
    assert "Expand" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def events(days):
    ev = []
    for d in days:
        for u in range(d % 3 + 1):
            for i, name in enumerate(("add_to_cart", "begin_checkout", "purchase")[: u + 1]):
                ev.append(conversion_event(f"u{u}", us(2024, 1, d, 10, i), name, usd=1.25 * d, tid=f"{d}-{u}" if name == "purchase" else None, sid=d * 10 if u else None))
    return ev


def test_days_are_added_and_replaced_without_reading_others(spark, tmp_path):
    folder = str(tmp_path / "days")
    conv = lambda days: conversions(make_events(spark, events(days)), CFG)
    add_days(conv([12, 13]), folder, ["20240112", "20240113"])
    assert rows_of(funnel_of_days(spark, folder, "20240110", "20240131")) == rows_of(purchase_funnel(conv([12, 13])))
    add_days(conv([14]), folder, ["20240114"])  # the other days' conversions are not there to be read
    assert rows_of(funnel_of_days(spark, folder, "20240110", "20240131")) == rows_of(purchase_funnel(conv([12, 13, 14])))
    assert rows_of(funnel_of_days(spark, folder, "20240113", "20240114")) == rows_of(purchase_funnel(conv([13, 14])))
    less = conversions(make_events(spark, [conversion_event("u9", us(2024, 1, 13, 9), "add_to_cart", sid=5)]), CFG)
    add_days(less, folder, ["20240113"])
    want = conversions(make_events(spark, [*events([12, 14]), conversion_event("u9", us(2024, 1, 13, 9), "add_to_cart", sid=5)]), CFG)
    assert rows_of(funnel_of_days(spark, folder, "20240110", "20240131")) == rows_of(purchase_funnel(want))
    add_days(less.limit(0), folder, ["20240112"])
    assert {r.event_date for r in read_table(spark, f"{folder}/bits").select("event_date").distinct().collect()} == {"20240113", "20240114"}
    ids = read_table(spark, f"{folder}/dictionary")
    assert ids.count() == ids.select("kind", "key").distinct().count() == ids.select("id").distinct().count()


def test_numbers_are_dense_so_bitmaps_are_few(spark, tmp_path):
    ev = spark.range(40_000).select(F.concat(F.lit("u"), "id").alias("user_pseudo_id"), F.lit("purchase").alias("conversion_event"), F.lit("20240112").alias("event_date"),
                                    F.col("id").alias("conversion_session_id"), F.lit(1.0).alias("purchase_revenue_in_usd"))
    folder = str(tmp_path / "days")
    add_days(ev, folder, ["20240112"])
    assert read_table(spark, f"{folder}/bits").count() <= 2 * 16
    r = funnel_of_days(spark, folder, "20240101", "20240131").first()
    assert (r.stage, r.unique_users, r.unique_sessions, r.total_events, r.stage_revenue_usd) == ("purchase", 40_000, 40_000, 40_000, 40_000.0)
