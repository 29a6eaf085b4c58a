"""Physical-plan properties: pushdown, no Python UDFs, one-pass models,
bucketed (equi-key) lookback join."""

import re

import pytest

from __spark_entry__ import LLM_QUERIES
from conftest import SF_SMALL
from tributary.config import FIXTURE_CONFIG
from tributary.plans.catalog import registry
from tributary.operators.journeys import MODEL_FIELDS, matched
from tributary.plans.pipeline import Pipeline
from tributary.sources.events import read_events
from tributary.sources.fixtures import fixture_events_nested

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange\b", plan_of(df)))


@pytest.fixture(scope="module")
def pipe(spark):
    return Pipeline.from_fixture(spark, SF_SMALL)


def test_no_python_in_any_registered_query(spark):
    skip = {"model_weights", "feature_importance"}  # tiny driver-built frames of fitted numbers
    for name, fn in registry().items():
        if name in skip or name in LLM_QUERIES:
            continue
        plan = plan_of(fn(spark, SF_SMALL))
        assert not any(n in plan for n in PYTHON_NODES), name


def test_models_add_no_shuffle_over_journeys(spark, pipe):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert exchanges(pipe.rule_mart) == exchanges(pipe.journeys)
        for m in ("linear", "time_decay", "u_shape"):
            assert exchanges(pipe.model(m)) == exchanges(pipe.journeys)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookback_join_is_equi_join_on_user_and_bucket(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = Pipeline.from_fixture(spark, SF_SMALL)
        plan = plan_of(matched(p.sessions, p.conversions, p.cfg, MODEL_FIELDS))
        joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[([^\]]*)\], \[([^\]]*)\], Inner", plan)
        assert any("user_pseudo_id" in a and "_bucket" in a and "_sb" in b for a, b in joins), joins
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        # the conversions' exchange is reused for the payload: two scans of the events
        assert "ReusedExchange" in plan
        assert len(re.findall(r"FileScan parquet .*event_id", plan)) == 2
        assert "page_referrer" not in re.search(r"collect_list\(.*", plan).group(0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_pruning_and_pushdown_on_export(spark, tmp_path):
    path = str(tmp_path / "export")
    fixture_events_nested(spark, SF_SMALL).write.partitionBy("event_date").parquet(path)
    df = read_events(spark, path, FIXTURE_CONFIG)
    plan = plan_of(df.where("event_name IN ('purchase')").select("user_pseudo_id", "event_timestamp"))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(event_name), EqualTo(event_name,purchase)]" in plan
    assert "ReadSchema: struct<event_timestamp:bigint,event_name:string,user_pseudo_id:string>" in plan


def test_nested_column_pruning_reads_only_needed_fields(spark, tmp_path):
    path = str(tmp_path / "export2")
    fixture_events_nested(spark, SF_SMALL).write.partitionBy("event_date").parquet(path)
    from tributary.sources.events import flatten_events
    flat = flatten_events(read_events(spark, path, FIXTURE_CONFIG), FIXTURE_CONFIG)
    plan = plan_of(flat.select("device_category", "country"))
    rs = re.search(r"ReadSchema: (struct<.*?>)\n", plan + "\n").group(1)
    assert "device:struct<category:string>" in rs and "geo:struct<country:string>" in rs
    assert "event_params" not in rs


def test_a_conversion_has_two_copies_at_most(spark):
    from pyspark.sql import functions as F

    from tributary.operators.journeys import lookback_lower_bound
    from tributary.plans.joins import explode_buckets
    cfg = FIXTURE_CONFIG
    c = Pipeline.from_fixture(spark, SF_SMALL).conversions.select("conversion_us")
    c = c.select("conversion_us", explode_buckets(lookback_lower_bound(F.col("conversion_us"), F.lit(cfg.max_lookback), cfg), F.col("conversion_us"), cfg.join_bucket_micros))
    assert c.groupBy("conversion_us").agg(F.countDistinct("_bucket").alias("n")).where("n > 2").count() == 0


def test_no_window_over_all_rows_of_a_report(spark, pipe):
    """Percentages use a one-row total: no unpartitioned window over channels, paths or source pairs."""
    for name in ("path_analysis_top50", "paths_dashboard_top20", "channel_volume", "linear_channel", "cross_channel_wide"):
        plan = plan_of(registry()[name](spark, SF_SMALL))
        assert "Window" not in plan, name


def test_reports_count_conversions_without_a_distinct(spark):
    for name in ("cross_channel", "roas"):
        plan = plan_of(registry()[name](spark, SF_SMALL))
        assert "partial_count(distinct" not in plan and "Expand" not in plan, name


def test_library_has_no_cache_or_local_checkpoint():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent
    for f in [*root.glob("tributary/**/*.py"), root / "bench.py"]:
        text = f.read_text()
        assert ".persist(" not in text and "localCheckpoint(" not in text and ".cache()" not in text, f
