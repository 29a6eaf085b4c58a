"""Table sinks: dynamic partition overwrite and the incremental refresh."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, conversion_event, make_events, session_event, us
from tributary.config import FIXTURE_CONFIG, AttributionConfig
from tributary.sources.fixtures import fixture_events, fixture_events_nested
from tributary.streaming import incremental
from tributary.streaming.incremental import days_between, incremental_stream, refresh_staging
from tributary.streaming.tables import AuditError, open_view, read_table, register_view, vacuum, write_audited, write_incremental, write_table

ALL_DAYS = days_between(FIXTURE_CONFIG.scan_start_date, FIXTURE_CONFIG.end_date)
CFG = AttributionConfig(start_date="20240110", end_date="20240131")


def test_write_incremental_overwrites_only_present_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 2)], "k string, d string, v int")
    write_incremental(df, path, "d")
    write_incremental(spark.createDataFrame([("c", "d2", 3)], "k string, d string, v int"), path, "d")
    got = sorted((r.k, r.d) for r in read_table(spark, path).collect())
    assert got == [("a", "d1"), ("c", "d2")]


def test_write_incremental_clears_named_partitions_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_incremental(spark.createDataFrame([("a", "d1", 1), ("b", "d2", 2), ("c", "d3", 2)], "k string, d string, v int"), path, "d")
    write_incremental(spark.createDataFrame([("x", "d1", 1), ("y", "d3", 1)], "k string, d string, v int"), path, "d", values=["d1", "d2"])
    assert sorted((r.k, r.d) for r in read_table(spark, path).collect()) == [("c", "d3"), ("x", "d1")]


def test_refresh_staging_is_idempotent_and_matches_full(spark, tmp_path):
    out = str(tmp_path / "stg")
    ev = fixture_events(spark, SF_SMALL)
    refresh_staging(ev, FIXTURE_CONFIG, out, ALL_DAYS)
    read = lambda: (read_table(spark, f"{out}/stg_conversions").count(), read_table(spark, f"{out}/stg_sessions").count())
    full = read()
    refresh_staging(ev, FIXTURE_CONFIG, out)
    assert read() == full
    refresh_staging(ev, FIXTURE_CONFIG, out)
    assert read() == full
    s = read_table(spark, f"{out}/stg_sessions")
    assert s.groupBy("user_pseudo_id", "session_id").count().where("count > 1").count() == 0


def test_trailing_refresh_keeps_the_whole_last_day(spark, tmp_path):
    """Three conversions on the end date, all after midnight, survive the default refresh."""
    out, end = str(tmp_path / "stg"), us(2024, 1, 31, 9)
    ev = make_events(spark, [conversion_event("u", end + i * 3_600_000_000, usd=1.0, tid=f"T{i}") for i in range(3)])
    for _ in range(2):
        refresh_staging(ev, CFG, out)
        assert read_table(spark, f"{out}/stg_conversions").count() == 3


def test_late_event_moves_a_session_to_the_day_before(spark, tmp_path):
    out, noon = str(tmp_path / "stg"), us(2024, 1, 20, 0, 30)
    first = [session_event("u", 9, noon, "news", "email")]
    refresh_staging(make_events(spark, first), CFG, out, ["20240120"])
    late = first + [session_event("u", 9, noon - 3_600_000_000, "google", "organic")]
    refresh_staging(make_events(spark, late), CFG, out, ["20240119"])
    got = [(r.session_id, r.channel, str(r.session_date)) for r in read_table(spark, f"{out}/stg_sessions").collect()]
    assert got == [(9, "Organic Search", "2024-01-19")]


def test_streaming_refresh_available_now(spark, tmp_path):
    src = str(tmp_path / "export")
    nested = fixture_events_nested(spark, SF_SMALL)
    nested.where(F.col("event_date") < "20240120").write.partitionBy("event_date").parquet(src)
    schema = spark.read.parquet(src).schema
    out, ck = str(tmp_path / "stg"), str(tmp_path / "ck")
    cfg = FIXTURE_CONFIG.with_(start_date="20240101", end_date="20240131")
    q = incremental_stream(spark, src, schema, out, cfg, ck)
    q.awaitTermination(120)
    first = read_table(spark, f"{out}/stg_conversions").count()
    assert first > 0
    nested.where(F.col("event_date") >= "20240120").write.mode("append").partitionBy("event_date").parquet(src)
    q = incremental_stream(spark, src, schema, out, cfg, ck)
    q.awaitTermination(120)
    assert read_table(spark, f"{out}/stg_conversions").count() > first


def rows(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path).collect())


def test_a_failed_write_leaves_the_old_rows_and_readers_keep_theirs(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_table(df, path)
    before = read_table(spark, path)
    with pytest.raises(Exception, match="stop"):
        write_table(df.withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v"))), path)
    assert rows(spark, path) == [("a", 1), ("b", 2)]
    write_table(read_table(spark, path).withColumn("v", F.col("v") * 10), path)  # may read itself
    write_table(spark.createDataFrame([("c", 3)], "k string, v int"), path, mode="append")
    assert rows(spark, path) == [("a", 10), ("b", 20), ("c", 3)]
    assert sorted(tuple(r) for r in before.collect()) == [("a", 1), ("b", 2)]
    vacuum(spark, path)
    assert rows(spark, path) == [("a", 10), ("b", 20), ("c", 3)]
    write_table(df.limit(0), path)
    assert rows(spark, path) == [] and read_table(spark, path).columns == ["k", "v"]


def test_of_two_writers_the_second_fails(spark, tmp_path, monkeypatch):
    from tributary.streaming import tables
    path = str(tmp_path / "t")
    write_table(spark.range(3).toDF("v"), path)
    stale = tables._manifest(spark, path)
    write_table(spark.range(5).toDF("v"), path)
    monkeypatch.setattr(tables, "_manifest", lambda *a: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        write_table(spark.range(7).toDF("v"), path)
    monkeypatch.undo()
    assert read_table(spark, path).count() == 5


def test_views_are_opened_by_other_sessions_and_see_new_versions(spark, tmp_path):
    path, views = str(tmp_path / "t"), str(tmp_path / "views")
    write_table(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, partition_by=["k"])
    register_view(spark, views, "twice", "SELECT k, 2 * v AS w FROM {t}", {"t": path})
    register_view(spark, views, "total", "SELECT sum(w) AS s FROM {x}", {"x": "view:twice"})
    assert open_view(spark.newSession(), views, "total").first().s == 6
    write_incremental(spark.createDataFrame([("b", 5)], "k string, v int"), path, "k")
    assert open_view(spark.newSession(), views, "total").first().s == 12
    with pytest.raises(Exception, match="nothing"):
        register_view(spark, views, "bad", "SELECT nothing FROM {t}", {"t": path})
    assert not (tmp_path / "views" / "bad.json").exists()


def test_refresh_reads_the_partitions_of_touched_sessions_only(spark, tmp_path):
    """A late event on the 24th of a session that began on the 22nd: of the events, only these days are opened."""
    day = lambda d, h=12: us(2024, 1, d, h)
    ev = [session_event("u", 1, day(22, 23), "news", "email"), session_event("u", 1, day(23, 1)), session_event("u", 2, day(20)), session_event("w", 3, day(25)),
          session_event("w", 4, day(22, 20), "google", "organic")]
    src, out = str(tmp_path / "src"), str(tmp_path / "stg")
    make_events(spark, ev).write.partitionBy("event_date").parquet(src)
    read = lambda: spark.read.parquet(src).withColumn("event_date", F.col("event_date").cast("string"))
    refresh_staging(read(), CFG, out, days_between("20240101", "20240131"))
    make_events(spark, [session_event("u", 1, day(24, 1))]).write.mode("append").partitionBy("event_date").parquet(src)
    index = read_table(spark, f"{out}/session_days")
    _, _, days = incremental.touched_days(read(), CFG, index, ["20240124"], lambda df: df)
    assert days == ["20240122", "20240123", "20240124"]
    plan = read().where(F.col("event_date").isin(*days))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20240122" in plan.split("PartitionFilters", 1)[1]
    (tmp_path / "src" / "event_date=20240125").rename(tmp_path / "hidden")  # a day that must not be read
    (tmp_path / "src" / "event_date=20240120").rename(tmp_path / "hidden2")
    refresh_staging(read(), CFG, out, ["20240124"])
    got = {(r.user_pseudo_id, r.session_id): str(r.session_date) for r in read_table(spark, f"{out}/stg_sessions").collect()}
    assert got == {("u", 1): "2024-01-22", ("u", 2): "2024-01-20", ("w", 3): "2024-01-25", ("w", 4): "2024-01-22"}
    spans = sorted((r.session_id, r.event_date, str(r.session_date)) for r in read_table(spark, f"{out}/session_days").collect())
    assert spans == [(1, f"202401{d}", "2024-01-22") for d in (22, 23, 24)] + [(2, "20240120", "2024-01-20"), (3, "20240125", "2024-01-25"), (4, "20240122", "2024-01-22")]


def test_days_that_are_taken_back_take_their_sessions_along(spark, tmp_path):
    """A day is loaded again without some of its events: sessions go, or fall back to the days that are left."""
    a, b = session_event("u", 1, us(2024, 1, 20, 23), "news", "email"), session_event("u", 1, us(2024, 1, 21, 1), "google", "organic")
    c = session_event("w", 2, us(2024, 1, 20, 5), "x", "social")
    out = str(tmp_path / "stg")
    refresh_staging(make_events(spark, [a, b, c]), CFG, out, ["20240120", "20240121"])
    refresh_staging(make_events(spark, [b]), CFG, out, ["20240120"])
    got = [(r.user_pseudo_id, str(r.session_date), r.source) for r in read_table(spark, f"{out}/stg_sessions").collect()]
    assert got == [("u", "2024-01-21", "google")]
    assert [(r.session_id, r.event_date) for r in read_table(spark, f"{out}/session_days").collect()] == [(1, "20240121")]


def test_a_table_that_fails_its_audit_is_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    metrics = [F.count(F.when(F.col("v") < 0, 1)).alias("negative"), F.sum("v").alias("total")]
    audit = lambda m: ["negative"] if m["negative"] else []
    got = write_audited(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, metrics, audit)
    assert got == {"negative": 0, "total": 3}
    with pytest.raises(AuditError, match="negative") as e:
        write_audited(spark.createDataFrame([("a", 1), ("b", -2)], "k string, v int"), path, metrics, audit, ["k"])
    assert e.value.metrics == {"negative": 1, "total": -1}
    assert rows(spark, path) == [("a", 1), ("b", 2)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version=")]) == 1


def test_the_mart_is_audited_in_the_job_that_writes_it(spark, tmp_path):
    from tributary.operators.quality import mart_metrics, mart_report
    from tributary.plans.catalog import broken_mart, pipe
    p = pipe(spark, SF_SMALL)
    metrics = mart_metrics(p.cfg, ("last_click", "linear"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "audit")
    report = {}
    failing = lambda m: report.update(mart_report(m)) or [c for c, n in mart_report(m) if n]
    with pytest.raises(AuditError, match="unknown_event"):
        write_audited(broken_mart(p), str(tmp_path / "mart"), metrics, failing, ["model"])
    assert tracker.getJobIdsForGroup("audit")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert report["unknown_event"] > 0 and report["unknown_channel"] > 0 and report["count_mode_value"] > 0 and report["credit:linear"] == 1 and report["null_key"] == 0
