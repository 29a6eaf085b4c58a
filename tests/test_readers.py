"""Nested export readers (all four source modes), param lookup, cost readers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tributary.config import FIXTURE_CONFIG
from tributary.functions.params import event_param
from tributary.sources import cost as cost_src
from tributary.sources.events import flatten_events
from tributary.sources.fixtures import CLICK_IDS, FLAT_EVENT_COLUMNS, NESTED_NUMBERS, NESTED_TEXT, fixture_events, fixture_events_nested


def test_flatten_equals_flat_fixture(spark):
    """Params mode gives the flat fixture back (the nested one also has click
    ids, page context and consent; the other modes are oracle queries)."""
    filled = {"items", "page_location", *(c for c, *_ in CLICK_IDS + NESTED_TEXT + NESTED_NUMBERS)}
    skip = [c for c in FLAT_EVENT_COLUMNS if c in filled or c.startswith("privacy")]
    flat = fixture_events(spark, SF_SMALL)
    got = flatten_events(fixture_events_nested(spark, SF_SMALL), FIXTURE_CONFIG)
    assert got.columns == list(FLAT_EVENT_COLUMNS)
    got, flat = got.drop(*skip), flat.drop(*skip)
    assert got.exceptAll(flat).count() == 0 and flat.exceptAll(got).count() == 0


def test_missing_optional_struct_raises(spark):
    legacy = fixture_events_nested(spark, SF_SMALL, modern=False)
    flatten_events(legacy, FIXTURE_CONFIG)  # event_params mode works on old exports
    for mode in ("session_stslc", "collected", "auto"):
        with pytest.raises(ValueError):
            flatten_events(legacy, FIXTURE_CONFIG.with_(source_mode=mode))
    with pytest.raises(ValueError):
        flatten_events(legacy, FIXTURE_CONFIG.with_(has_privacy_info=True))


def test_event_param_first_match_and_missing(spark):
    df = spark.createDataFrame(
        [([("a", ("x", None, None, None)), ("a", ("y", None, None, None)), ("n", (None, 7, None, None))],)],
        "event_params array<struct<key:string, value:struct<string_value:string, int_value:bigint, "
        "float_value:double, double_value:double>>>")
    r = df.select(event_param("a").alias("a"), event_param("n", "int").alias("n"),
                  event_param("zz").alias("z")).first()
    assert (r.a, r.n, r.z) == ("x", 7, None)


def test_modeled_events_filter(spark):
    from tributary.operators.sessions import sessions
    nested = fixture_events_nested(spark, SF_SMALL).withColumn(
        "privacy_info", F.struct(F.lit("Yes").alias("analytics_storage"), F.lit("Yes").alias("ads_storage"),
                                 F.lit("Yes").alias("uses_transient_token")))
    cfg = FIXTURE_CONFIG.with_(has_privacy_info=True, exclude_modeled_events=True)
    assert sessions(flatten_events(nested, cfg), cfg).count() == 0
    # the raw field decides, whether or not the privacy columns are carried
    bare = cfg.with_(has_privacy_info=False)
    assert flatten_events(nested, bare).count() == 0
    with pytest.raises(ValueError):
        flatten_events(fixture_events_nested(spark, SF_SMALL, modern=False), bare)
    cfg2 = cfg.with_(exclude_modeled_events=False)
    assert sessions(flatten_events(nested, cfg2), cfg2).count() > 0


def test_cost_readers_csv_roundtrip_and_null_guard(spark, tmp_path):
    p = str(tmp_path / "meta.csv")
    rows = [("2024-01-02", "Paid Social", "spring", "12.5", "100", "7"), ("", "Paid Social", "x", "1", "1", "1"),
            ("2024-01-03", "Paid Social", "y", "", "1", "1")]
    spark.createDataFrame(rows, "date string, channel string, campaign string, cost_usd string, "
                                "impressions string, clicks string").coalesce(1).write.option("header", True).csv(p)
    df = cost_src.read_cost_meta(spark, p, fmt="csv", options={"header": "true"})
    got = df.collect()
    assert len(got) == 1 and got[0].source_system == "meta_ads" and got[0].cost_usd == 12.5
    assert cost_src.read_cost_google(spark).count() == 0
    assert cost_src.read_cost_google(spark).columns == list(cost_src.COST_COLUMNS)


def test_google_ads_channel_map(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", t, "c", 1_500_000, 10, 2) for t in ("SEARCH", "DISPLAY", "SHOPPING", "VIDEO", "PERFORMANCE_MAX", "APP")],
        "date string, campaign_advertising_channel_type string, campaign_name string, cost_micros bigint, "
        "impressions bigint, clicks bigint")
    got = [(r.channel, r.cost_usd) for r in cost_src.google_ads_cost(raw).collect()]
    assert got == [("Paid Search Non-Brand", 1.5), ("Display", 1.5), ("Paid Shopping", 1.5), ("Paid Video", 1.5),
                   ("Cross-network", 1.5), ("Paid Search Non-Brand", 1.5)]


def test_shards_of_several_schemas_are_read_by_day(spark, tmp_path):
    from tributary.sources.shards import read_sharded_events, schema_groups, shards
    root = str(tmp_path)
    nested = fixture_events_nested(spark, SF_SMALL)
    day = lambda d: nested.where(F.col("event_date") == d)
    old = ("session_traffic_source_last_click", "collected_traffic_source", "privacy_info")
    day("20240116").drop(*old).write.parquet(f"{root}/events_20240116")
    day("20240117").drop(*old, "items").write.parquet(f"{root}/events_20240117")
    day("20240118").drop("event_date").write.parquet(f"{root}/events_20240118")
    day("20240119").withColumn("items", F.transform("items", lambda x: x.dropFields("price").withField("brand", F.lit("b")))).write.parquet(f"{root}/events_20240119")
    for other in ("events_20230101", "events_intraday_20240117", "events_20240301", "notes"):
        (tmp_path / other).mkdir()
        (tmp_path / other / "part.parquet").write_text("no parquet file")
    found = shards(spark, root, "20231216", "20240131")
    assert list(found) == ["20240116", "20240117", "20240118", "20240119"]
    assert len(schema_groups(spark, list(found.values()), "parquet")) == 4
    cfg = FIXTURE_CONFIG.with_(source_mode="auto", has_privacy_info=True)
    got = read_sharded_events(spark, root, cfg)
    assert got.columns == list(FLAT_EVENT_COLUMNS)
    by = {r.event_date: r for r in got.groupBy("event_date").agg(F.count("*").alias("n"), F.count("privacy_analytics_storage").alias("privacy"), F.count("items").alias("items"),
                                                              F.count("last_click_source").alias("clicks"), F.sum(F.col("items")[0]["price"]).alias("price")).collect()}
    assert {d: r.n for d, r in by.items()} == {d: day(d).count() for d in found}
    assert [by[d].privacy > 0 for d in sorted(by)] == [False, False, True, True] and [by[d].clicks > 0 for d in sorted(by)] == [False, False, True, True]
    assert [by[d].items > 0 for d in sorted(by)] == [True, False, True, True] and by["20240119"].price is None and by["20240118"].price > 0
    plan = got.select("event_name", "last_click_source")._jdf.queryExecution().executedPlan().toString()
    assert "ecommerce" not in plan and "events_20230101" not in plan
    with pytest.raises(ValueError):  # no day of the scan has what the mode needs
        read_sharded_events(spark, root, cfg.with_(start_date="20240116", end_date="20240117", widen_scan=False))
    with pytest.raises(FileNotFoundError):
        read_sharded_events(spark, root, cfg.with_(start_date="20240601", end_date="20240602"))
