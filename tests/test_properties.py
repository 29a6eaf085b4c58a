"""Invariants over the whole sf0.001 fixture run."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, conversion_event, make_events, session_event, us
from tributary.operators import models, quality
from tributary.plans.pipeline import Pipeline


@pytest.fixture(scope="module")
def pipe(spark):
    return Pipeline.from_fixture(spark, SF_SMALL)


def test_credit_sums_within_rounding(pipe):
    m = pipe.rule_mart.groupBy("model", "conversion_id").agg(
        F.sum(F.col("attributed_credit").cast("decimal(20,6)")).alias("s"), F.first("path_length").alias("n"))
    bad = m.where(F.abs(F.col("s") - 1) > F.col("n") * 5e-5).count()
    assert bad == 0


def test_unrounded_credits_conserve_exactly(pipe):
    m = models.attribution_mart(pipe.journeys, pipe.cfg.with_(round_credit=False))
    s = m.groupBy("model", "conversion_id").agg(F.sum("attributed_credit").alias("s"))
    assert s.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_single_touch_models_one_row_per_conversion(pipe):
    n = pipe.journeys.count()
    for m in ("first_click", "last_click", "last_non_direct_click"):
        assert pipe.model(m).count() == n


def test_lnd_window_form_equals_full_outer_form(pipe):
    lit = models.last_non_direct_click_full_outer(pipe.path_rows, pipe.cfg)
    assert quality.lnd_forms_agree(pipe.model("last_non_direct_click"), lit).count() == 0


def test_revenue_conservation_and_dq_checks_pass(pipe):
    assert quality.dq_revenue_conservation(pipe.rule_mart, pipe.journeys, pipe.cfg).count() == 0
    assert quality.dq_count_mode_null(pipe.rule_mart, pipe.cfg).count() == 0
    assert quality.dq_channel_coverage(pipe.rule_mart).count() == 0
    assert quality.dq_session_dupes(pipe.sessions).count() == 0
    assert quality.dq_journey_dupes(pipe.journeys).count() == 0
    assert quality.dq_credit_sums(pipe.rule_mart).count() == 0


def test_declared_assertions_hold(pipe):
    for df, spec in ((pipe.conversions, quality.CONVERSION_ASSERTIONS), (pipe.journeys, quality.JOURNEY_ASSERTIONS),
                     (pipe.path_rows, quality.PATH_ROW_ASSERTIONS)):
        assert quality.assertion_failures(df, spec).where("failing_rows > 0").count() == 0


def test_dq_checks_catch_violations(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 2.0), ("b", 2, -1.0)], "u string, k int, v double")
    assert quality.dq_unique(df, ["u", "k"]).first().dupes == 2
    assert quality.dq_not_null(df, ["v"]).count() == 1
    assert quality.dq_row_condition(df, "v >= 0").count() == 2  # NULL fails too


def test_path_positions_consistent(pipe):
    pr = pipe.path_rows
    assert pr.where(F.col("session_position_asc") + F.col("session_position_desc") != F.col("path_length") + 1).count() == 0
    ordered = pr.groupBy("conversion_id").agg(F.sort_array(F.collect_list(F.struct("session_position_asc", "session_start"))).alias("a"))
    bad = ordered.where(~F.expr("aggregate(sequence(1, size(a) - 1), true, (acc, i) -> acc and a[i - 1].session_start <= a[i].session_start)") & (F.size("a") > 1))
    assert bad.count() == 0


@pytest.mark.parametrize("days,seconds", [(1, 86400), (2, 3600), (90, 1)])
def test_bucket_width_does_not_change_results(spark, pipe, days, seconds):
    """The time-bucketed join and the per-bucket numbering are exact: any
    bucket width gives the same journeys, numbering and legacy features."""
    cols = ["conversion_id", "conversion_event", "path_length", "user_conversion_seq", "conversion_value_usd"]
    base = pipe.journeys.select(*cols, F.size("path").alias("n"))
    widths = {"join_bucket_days": days, "number_bucket_seconds": seconds}
    other = Pipeline(pipe.events, pipe.cfg.with_(**widths), standalone_cfg=pipe.sa_cfg.with_(**widths))
    got = other.journeys.select(*cols, F.size("path").alias("n"))
    assert base.exceptAll(got).count() == 0 and got.exceptAll(base).count() == 0
    assert other.sa_features.exceptAll(pipe.sa_features).count() == 0
    assert other.sa_conversions.exceptAll(pipe.sa_conversions).count() == 0


def test_materialized_layers_give_same_marts(spark):
    from tributary.plans.session import shared_dir
    p = Pipeline.from_fixture(spark, SF_SMALL)
    ref = Pipeline.from_fixture(spark, SF_SMALL).rule_mart
    for layer in ("sessions", "conversions", "journeys"):
        p.materialize(layer)
    assert p.run_id in p.journeys.inputFiles()[0] and shared_dir(spark) in p.journeys.inputFiles()[0].replace("file:", "")
    got = p.rule_mart
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    p.cleanup()
    assert not os.path.exists(f"{shared_dir(spark).replace('file:', '')}/layers/{p.run_id}")


def test_single_touch_models_without_pairs_equal_the_path_form(spark, pipe):
    from tributary.operators.models import single_model
    from tributary.operators.single_touch import single_touch
    for cfg in (pipe.cfg, pipe.cfg.with_(lookback_mode="exact")):
        p = Pipeline(pipe.events, cfg)
        got = single_touch(p.sessions, p.conversions, cfg)
        for m in ("first_click", "last_click", "last_non_direct_click"):
            a, b = got.where(F.col("model") == m), single_model(p.journeys, cfg, m)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, m


def test_one_user_with_a_third_of_a_day(spark):
    """A bot's day: numbering and single-touch models agree with plain windows."""
    from pyspark.sql import Window
    from tributary.operators.journeys import journeys
    from tributary.operators.conversions import conversions
    from tributary.operators.models import single_model
    from tributary.operators.sessions import sessions
    from tributary.operators.single_touch import single_touch
    from tributary.config import AttributionConfig
    day = us(2024, 1, 20)
    rows = [session_event("bot", i, day + i * 3_600_000_000, "google", "organic" if i % 2 else None) for i in range(24)]
    rows += [conversion_event("bot", day + i * 60_000_000 + 5, usd=1.0, tid=f"T{i}") for i in range(1440)]
    for u in range(40):
        rows += [session_event(f"u{u}", 1, day + u * 60_000_000, "news", "email"), conversion_event(f"u{u}", day + 4_000_000_000, usd=2.0, tid=f"U{u}")]
    cfg = AttributionConfig(start_date="20240110", end_date="20240131")
    ev = make_events(spark, rows)
    s, c = sessions(ev, cfg), conversions(ev, cfg)
    j = journeys(s, c, cfg)
    w = Window.partitionBy("user_pseudo_id").orderBy("conversion_us", "conversion_event", "transaction_id")
    assert j.withColumn("n", F.row_number().over(w)).where("n <> user_conversion_seq").count() == 0
    assert j.count() == 1480
    a, b = single_touch(s, c, cfg, ("last_non_direct_click",)), single_model(j, cfg, "last_non_direct_click")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
