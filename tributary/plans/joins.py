"""Join helpers: the bucketed lookback range join and numbering without per-key tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_buckets(lo_us, hi_us, bucket_us: int, name: str = "_bucket"):
    """One row per time bucket overlapped by [lo_us, hi_us] (epoch micros).
    There always is one; the outer form keeps the optimiser from pushing a
    non-empty test below the caller's aggregates, where it would make
    otherwise equal exchanges differ."""
    lo = F.floor(lo_us / F.lit(bucket_us))
    hi = F.floor(hi_us / F.lit(bucket_us))
    return F.explode_outer(F.sequence(lo.cast("long"), hi.cast("long"))).alias(name)


def row_number_within(df: DataFrame, key: str, day, order_cols, name: str) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY key ORDER BY order_cols)``
    without putting a whole key group in one task.

    ``day`` (a Column or column name) is a time bucket, monotone in
    ``order_cols`` (e.g. the minute of the leading timestamp). Rows are
    numbered within (key, bucket); each bucket is then offset by the row
    counts of the key's earlier buckets, taken from a count table whose
    window runs over at most one row per active bucket. A key with a third of
    all rows is thus split over its buckets. ``df`` is read twice: hand in a
    stored one if it is expensive.
    """
    from pyspark.sql import Window

    d = F.col(day) if isinstance(day, str) else day
    df = df.withColumn("_rn_day", d)
    local = Window.partitionBy(key, "_rn_day").orderBy(*order_cols)
    numbered = df.withColumn("_rn_local", F.row_number().over(local))
    counts = numbered.groupBy(key, "_rn_day").agg(F.count(F.lit(1)).alias("_rn_n"))
    earlier = Window.partitionBy(key).orderBy("_rn_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_rn_day", F.coalesce(F.sum("_rn_n").over(earlier), F.lit(0)).alias("_rn_off"))
    out = numbered.join(offsets, [key, "_rn_day"], "inner")
    return out.withColumn(name, (F.col("_rn_off") + F.col("_rn_local")).cast("bigint")) \
              .drop("_rn_day", "_rn_local", "_rn_off")
