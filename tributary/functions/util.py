"""Small Column helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MICROS_PER_DAY, MICROS_PER_HOUR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dlit(x: float) -> Column:
    """A DOUBLE literal (SQL text `1.0` would be DECIMAL in Spark)."""
    return F.lit(float(x))


def nullif(c, v) -> Column:
    c = _col(c)
    return F.when(c == v, F.lit(None)).otherwise(c)


def safe_div(num, den) -> Column:
    """num / NULLIF(den, 0) as DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(_col(num).cast("double"), nullif(_col(den).cast("double"), 0.0))


def utc_date_from_micros(us) -> Column:
    """DATE of an epoch-micros instant in UTC, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(_col(us) / F.lit(MICROS_PER_DAY)).cast("int"))


def utc_date(ts) -> Column:
    return utc_date_from_micros(F.unix_micros(_col(ts)))


def whole_hours(later_us, earlier_us) -> Column:
    """TIMESTAMP_DIFF(later, earlier, HOUR): whole hours, truncated toward zero."""
    d = _col(later_us) - _col(earlier_us)
    return (F.when(d >= 0, F.floor(d / F.lit(MICROS_PER_HOUR)))
            .otherwise(F.ceil(d / F.lit(MICROS_PER_HOUR)))).cast("long")


def whole_days(later_us, earlier_us) -> Column:
    d = _col(later_us) - _col(earlier_us)
    return (F.when(d >= 0, F.floor(d / F.lit(MICROS_PER_DAY)))
            .otherwise(F.ceil(d / F.lit(MICROS_PER_DAY)))).cast("long")


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def exact_sum(c) -> Column:
    """SUM accumulated as DECIMAL(38,10): exact and independent of the order
    rows arrive in (a DOUBLE sum changes in its last bits with partitioning).
    Use for money and credit totals that are then rounded."""
    return F.sum(_col(c).cast("decimal(38,10)"))


def round_to(c, digits: int) -> Column:
    """ROUND(c, digits) returned as DOUBLE."""
    return F.round(_col(c), digits).cast("double")
