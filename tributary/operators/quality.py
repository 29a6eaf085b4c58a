"""Data-quality checks. Every check returns the offending rows (empty = pass)
as a DataFrame; nothing is collected unless the caller asks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.channels import CHANNELS


def _c(x) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def dq_unique(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once (NULLs group together, as in GROUP BY)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dupes")).where(F.col("dupes") > 1)


def dq_not_null(df: DataFrame, cols) -> DataFrame:
    """Rows with a NULL in any of ``cols``, tagged with the first NULL column."""
    cond = None
    tag = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
        tag = F.when(F.col(c).isNull(), F.lit(c)) if tag is None else tag.when(F.col(c).isNull(), F.lit(c))
    return df.where(cond).withColumn("null_column", tag)


def dq_row_condition(df: DataFrame, expr) -> DataFrame:
    """Rows where ``expr`` is not TRUE (a NULL result fails)."""
    return df.where(~F.coalesce(_c(expr), F.lit(False)))


# -- the declared assertions of the staging / intermediate tables ---------------

CONVERSION_ASSERTIONS = dict(
    unique=("user_pseudo_id", "conversion_ts", "conversion_event", "transaction_id"),
    not_null=("user_pseudo_id", "conversion_ts", "conversion_event"),
    rows=("purchase_revenue_in_usd IS NULL OR purchase_revenue_in_usd >= 0", "conversion_ts IS NOT NULL"),
)
JOURNEY_ASSERTIONS = dict(
    unique=("user_pseudo_id", "conversion_ts", "conversion_event", "transaction_id"),
    not_null=("user_pseudo_id", "conversion_ts", "path_length"),
    rows=("conversion_value_usd IS NULL OR conversion_value_usd >= 0", "path_length >= 1",
          "size(path) = path_length"),
)
PATH_ROW_ASSERTIONS = dict(
    unique=("user_pseudo_id", "conversion_id", "session_id"),
    not_null=("user_pseudo_id", "conversion_id", "session_id", "session_start", "channel"),
    rows=("session_position_asc >= 1", "session_position_desc >= 1"),
)


def assertion_failures(df: DataFrame, spec: dict) -> DataFrame:
    """Count of failing rows per assertion of ``spec`` (one row per assertion),
    computed in a single aggregation pass plus one for uniqueness."""
    checks = []
    for c in spec["not_null"]:
        checks.append((f"not_null:{c}", F.col(c).isNull()))
    for r in spec["rows"]:
        checks.append((f"row:{r}", ~F.coalesce(F.expr(r), F.lit(False))))
    agg = df.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    arr = F.array(*[F.struct(F.lit(name).alias("assertion"), F.col(f"c{i}").alias("failing_rows"))
                    for i, (name, _) in enumerate(checks)])
    rows = agg.select(F.explode(arr).alias("a")).select("a.*")
    dup = dq_unique(df, spec["unique"]).agg(F.coalesce(F.sum("dupes"), F.lit(0)).cast("bigint").alias("failing_rows"))
    dup = dup.select(F.lit("unique:" + ",".join(spec["unique"])).alias("assertion"), "failing_rows")
    return rows.unionByName(dup)


# -- post-run validation queries ---------------------------------------------------

def dq_credit_sums(mart: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """(model, event, conversion) whose credits do not sum to 1 +- tolerance
    (exact decimal sum, rounded to 4 as the check does)."""
    agg = mart.groupBy("model", "conversion_event", "conversion_id").agg(
        F.round(F.sum(F.col("attributed_credit").cast("decimal(38,10)")), 4).alias("_s"))
    return agg.where(F.abs(F.col("_s") - F.lit(1)) > F.lit(tolerance).cast("decimal(10,6)")) \
              .select("model", "conversion_event", "conversion_id", F.col("_s").cast("double").alias("credit_sum"))


def dq_unknown_events(mart: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Conversion events in the mart that are not configured."""
    return mart.where(~F.col("conversion_event").isin(*cfg.event_names)).select("conversion_event").distinct()


def dq_revenue_conservation(mart: DataFrame, journeys_df: DataFrame, cfg: AttributionConfig,
                            tolerance: float = 5.0) -> DataFrame:
    """Per model and revenue-mode event: attributed total vs raw journey total
    (the correlated scalar subquery is written as a join of two aggregates)."""
    ev = cfg.events_by_mode("revenue")
    a = mart.where(F.col("conversion_event").isin(*ev)).groupBy("model", "conversion_event") \
        .agg(F.sum(F.col("attributed_value_usd").cast("decimal(38,10)")).alias("_a"))
    r = journeys_df.where(F.col("conversion_event").isin(*ev)).groupBy("conversion_event") \
        .agg(F.sum(F.col("conversion_value_usd").cast("decimal(38,10)")).alias("_r"))
    j = a.join(r, "conversion_event", "left")
    return j.where(F.abs(F.col("_a") - F.col("_r")) > F.lit(tolerance).cast("decimal(10,4)")).select(
        "model", "conversion_event", F.round("_a", 6).cast("double").alias("attributed_total"),
        F.round("_r", 6).cast("double").alias("raw_total"))


def dq_count_mode_null(mart: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Count-mode rows whose attributed value is not NULL."""
    ev = cfg.events_by_mode("count")
    return mart.where(F.col("conversion_event").isin(*ev) & F.col("attributed_value_usd").isNotNull()) \
        .groupBy("model", "conversion_event").agg(F.count(F.lit(1)).alias("bad_rows"))


def dq_fixed_mode(mart: DataFrame, cfg: AttributionConfig, tolerance: float = 0.01) -> DataFrame:
    """Fixed-mode rows whose value differs from constant x credit."""
    bad = None
    for e in cfg.conversion_events:
        if e.value_mode != "fixed":
            continue
        c = (F.col("conversion_event") == e.event) & (
            F.abs(F.col("attributed_value_usd") - F.col("attributed_credit") * F.lit(float(e.fixed_value_usd)))
            > tolerance)
        bad = c if bad is None else bad | c
    if bad is None:
        bad = F.lit(False)
    return mart.where(bad).groupBy("model", "conversion_event").agg(F.count(F.lit(1)).alias("bad_rows"))


def dq_channel_coverage(df: DataFrame) -> DataFrame:
    """Channels outside the 19 canonical names."""
    return df.where(~F.col("channel").isin(*CHANNELS)).select("channel").distinct()


def dq_model_event_rows(data_driven_df: DataFrame) -> DataFrame:
    """Rows per conversion event of the data-driven output (informational)."""
    return data_driven_df.groupBy("conversion_event").agg(F.count(F.lit(1)).alias("rows"))


def dq_session_dupes(sessions_df: DataFrame) -> DataFrame:
    return dq_unique(sessions_df, ["user_pseudo_id", "session_id"])


def dq_journey_dupes(journeys_df: DataFrame) -> DataFrame:
    """Duplicates by (user, ts, event) -- transaction id deliberately omitted."""
    return dq_unique(journeys_df, ["user_pseudo_id", "conversion_ts", "conversion_event"])


def lnd_forms_agree(one_pass: DataFrame, full_outer: DataFrame) -> DataFrame:
    """Rows present in one last-non-direct form but not the other."""
    cols = ["conversion_id", "channel", "attributed_credit"]
    a, b = one_pass.select(*cols), full_outer.select(*cols)
    return a.exceptAll(b).unionByName(b.exceptAll(a))


# -- checks taken while a table is written ---------------------------------------------

def mart_metrics(cfg: AttributionConfig, models, tolerance: float = 0.01) -> list[Column]:
    """Aggregates of the mart, all from one pass over its rows as they are
    written: failing rows by check, and by model the attributed and the raw
    revenue (a model that gives one row to each conversion holds it) and the credit
    beyond one for each conversion."""
    event, value, credit, model = (F.col(c) for c in ("conversion_event", "attributed_value_usd", "attributed_credit", "model"))
    fails = {
        "null_key": reduce(or_, [F.col(c).isNull() for c in ("user_pseudo_id", "conversion_id", "conversion_event", "model", "channel", "attributed_credit")]),
        "unknown_event": ~event.isin(*cfg.event_names),
        "unknown_channel": ~F.col("channel").isin(*CHANNELS),
        "count_mode_value": event.isin(*cfg.events_by_mode("count")) & value.isNotNull(),
        "fixed_mode_value": reduce(or_, [(event == e.event) & (F.abs(value - credit * F.lit(float(e.fixed_value_usd))) > tolerance)
                                         for e in cfg.conversion_events if e.value_mode == "fixed"], F.lit(False)),
        "credit_range": (credit < 0) | (credit > 1),
    }
    out = [F.count(F.when(c, 1)).alias(f"rows:{n}") for n, c in fails.items()]
    revenue = event.isin(*cfg.events_by_mode("revenue"))
    total = lambda c, x: F.sum(F.when(c, x.cast("decimal(38,10)")))
    out.append(total(revenue & (model == "last_click"), F.col("conversion_value_usd")).alias("raw_revenue"))
    out.append(F.count(F.when(model == "last_click", 1)).alias("conversions"))
    for m in models:
        out += [total(revenue & (model == m), value).alias(f"revenue:{m}"), total(model == m, credit).alias(f"credit:{m}"), F.count(F.when(model == m, 1)).alias(f"n:{m}")]
    return out


def mart_report(metrics: dict, tolerance: float = 5.0, credit_drift: float = 0.001) -> list[tuple[str, int]]:
    """(check, failing rows; for totals 1 or 0) of ``mart_metrics``. Credits are
    rounded by row, so a model's total may drift by that much a conversion."""
    out = [(n.removeprefix("rows:"), int(v)) for n, v in metrics.items() if n.startswith("rows:")]
    raw, conversions = metrics["raw_revenue"] or 0, metrics["conversions"]
    for n, v in metrics.items():
        if n.startswith("revenue:") and metrics["n:" + n.removeprefix("revenue:")]:
            out.append((n, int(abs((v or 0) - raw) > tolerance)))
        elif n.startswith("credit:") and metrics["n:" + n.removeprefix("credit:")]:
            out.append((n, int(abs(float(v or 0) - conversions) > credit_drift * conversions)))
    return out
