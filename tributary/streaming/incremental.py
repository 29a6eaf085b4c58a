"""Incremental refresh of the staging tables for given days, and a Structured
Streaming driver that applies it as new event partitions land.

Staging tables are partitioned by day. Beside them stands an index of session
spans: a row for each session and event day, with the day under which the
session is stored. A refresh of some event days reads these days only to learn
which sessions they touch, looks up in the index on which other days these
sessions have events, and recomputes the touched sessions from these days'
partitions. Partitions in which a touched session stood or stands are written
anew, with the stored rows of the other sessions. A rerun changes nothing.
Only lists of days reach the driver.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.util import utc_date
from ..plans.session import delete_path, shared_dir, stored
from .tables import read_table, table_exists, write_incremental, write_table

SESSION_KEY = ["user_pseudo_id", "session_id"]


def _day(s: str) -> datetime:
    return datetime.strptime(s, "%Y%m%d")


def days_between(first: str, last: str) -> list[str]:
    n = (_day(last) - _day(first)).days
    return [(_day(first) + timedelta(days=i)).strftime("%Y%m%d") for i in range(n + 1)]


def trailing_days(cfg: AttributionConfig, days: int = 3) -> list[str]:
    """The last ``days`` days of the run, ``cfg.end_date`` included."""
    first = max(_day(cfg.end_date) - timedelta(days=days - 1), _day(cfg.start_date))
    return days_between(first.strftime("%Y%m%d"), cfg.end_date)


def whole_days(cfg: AttributionConfig) -> AttributionConfig:
    """Time bounds a day wider than the run on either side: rows are chosen by
    ``event_date``, whose days need not be UTC days."""
    first, last = _day(cfg.start_date) - timedelta(days=1), _day(cfg.end_date) + timedelta(days=1)
    return cfg.with_(start_date=first.strftime("%Y%m%d"), end_date=last.strftime("%Y%m%d"), end_inclusive=True)


def _session_days(events: DataFrame) -> DataFrame:
    return events.where(F.col("session_id").isNotNull()).select(*SESSION_KEY, "event_date").distinct()


def touched_days(events_flat: DataFrame, cfg: AttributionConfig, index: DataFrame, dates: list[str], store) -> tuple[DataFrame, DataFrame, list[str]]:
    """The sessions with an event on ``dates``, now or when last refreshed;
    their rows in the index; and the event days they need. Of the events only
    the partitions of ``dates`` are read."""
    now = _session_days(events_flat.where(F.col("event_date").isin(*dates))).select(*SESSION_KEY)
    touched = store(now.union(index.where(F.col("event_date").isin(*dates)).select(*SESSION_KEY)).distinct())
    spans = store(index.join(touched, SESSION_KEY, "left_semi"))
    days = {r[0] for r in spans.select("event_date").distinct().collect()} | set(dates)
    return touched, spans, sorted(d for d in days if cfg.scan_start_date <= d <= cfg.end_date)


def refresh_staging(events_flat: DataFrame, cfg: AttributionConfig, out_dir: str, dates: list[str] | None = None) -> None:
    """Bring the staging tables (``stg_sessions``, ``stg_conversions`` and the
    index ``session_days``) up to date for ``dates`` (event dates, YYYYMMDD;
    default: the trailing three days), which must name every day whose events
    have changed since it was last refreshed.

    Conversions of these dates are replaced, and so are all sessions with an
    event on one of them, wherever they stand. Where there is no index yet, it
    is first made from the keys of the whole scan range.
    """
    from ..operators.conversions import conversions
    from ..operators.sessions import sessions

    dates = trailing_days(cfg) if dates is None else sorted({d for d in map(str, dates) if cfg.scan_start_date <= d <= cfg.end_date})
    if not dates:
        return
    spark, wide = events_flat.sparkSession, whole_days(cfg)
    sessions_path, index_path, scratch = f"{out_dir}/stg_sessions", f"{out_dir}/session_days", f"{shared_dir(spark)}/refresh-{uuid.uuid4().hex}"
    events_flat = events_flat.withColumn("event_date", F.col("event_date").cast("string"))
    names = iter(range(1 << 30))
    store = lambda df: stored(df, f"{scratch}/{next(names)}")
    if not table_exists(spark, index_path):
        scan = events_flat.where(F.col("event_date").between(cfg.scan_start_date, cfg.end_date))
        write_table(_session_days(scan).withColumn("session_date", F.lit(None).cast("date")), index_path, partition_by=["event_date"])
    index = read_table(spark, index_path)
    touched, spans, days = touched_days(events_flat, cfg, index, dates, store)

    on_days = events_flat.where(F.col("event_date").isin(*days))
    fresh = sessions(on_days, wide).withColumn("session_date", utc_date("session_start"))
    fresh = store(fresh.join(touched, SESSION_KEY, "left_semi"))  # aggregated first: no event meets the keys
    stood = spans.select("session_date").union(fresh.select("session_date")).distinct()
    places = sorted(str(r[0]) for r in stood.collect() if r[0] is not None)
    if places:
        new = fresh
        if table_exists(spark, sessions_path):
            old = read_table(spark, sessions_path).where(F.col("session_date").isin(*[F.lit(p).cast("date") for p in places]))
            new = old.join(touched, SESSION_KEY, "left_anti").unionByName(fresh)
        write_incremental(new, sessions_path, "session_date", values=places)
    kept = index.where(F.col("event_date").isin(*days)).join(touched, SESSION_KEY, "left_anti")
    rows = _session_days(on_days).join(touched, SESSION_KEY, "left_semi").join(fresh.select(*SESSION_KEY, "session_date"), SESSION_KEY, "left")
    write_incremental(kept.unionByName(rows), index_path, "event_date", values=days)
    on_dates = events_flat.where(F.col("event_date").isin(*dates) & F.col("event_date").between(cfg.start_date, cfg.end_date))
    write_incremental(conversions(on_dates, wide), f"{out_dir}/stg_conversions", "event_date", values=dates)
    delete_path(spark, scratch)


def incremental_stream(spark: SparkSession, source_path: str, schema, out_dir: str, cfg: AttributionConfig,
                       checkpoint_location: str, flatten=None, trigger_once: bool = True):
    """Stream new event files from ``source_path`` and, per micro-batch,
    refresh the staging tables for the dates that the batch touched (and only
    those). ``flatten`` maps the raw export rows to flat events (default:
    nested export flattener). The file source's checkpoint remembers which
    files are done; of the source the refresh reads the days of the touched
    sessions, so late events of an old day see their whole sessions.
    """
    from ..sources.events import flatten_events
    flatten = flatten or (lambda df: flatten_events(df, cfg))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        # partition discovery may type event_date as an integer: normalise
        days = [str(r[0]) for r in batch.select("event_date").distinct().collect()]
        if days:
            refresh_staging(flatten(spark.read.schema(schema).parquet(source_path)), cfg, out_dir, days)

    stream = spark.readStream.schema(schema).parquet(source_path)
    w = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 hour")
    return w.start()
