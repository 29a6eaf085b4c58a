"""Config-driven Column expressions for conversion events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import UNLISTED_LOOKBACK_DAYS, UNLISTED_VALUE_MODE, AttributionConfig


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookback_case(event, cfg: AttributionConfig) -> Column:
    """event -> lookback days; unlisted events get 30."""
    event = _col(event)
    expr = None
    for e in cfg.conversion_events:
        expr = (F.when(event == e.event, F.lit(e.lookback_days)) if expr is None
                else expr.when(event == e.event, F.lit(e.lookback_days)))
    return expr.otherwise(F.lit(UNLISTED_LOOKBACK_DAYS))


def value_mode_case(event, cfg: AttributionConfig) -> Column:
    """event -> 'revenue' | 'fixed' | 'count'; unlisted events are 'count'."""
    event = _col(event)
    expr = None
    for e in cfg.conversion_events:
        expr = (F.when(event == e.event, F.lit(e.value_mode)) if expr is None
                else expr.when(event == e.event, F.lit(e.value_mode)))
    return expr.otherwise(F.lit(UNLISTED_VALUE_MODE))


def value_expr(event, value, credit, cfg: AttributionConfig) -> Column:
    """Attributed value: revenue -> value * credit, fixed -> constant * credit,
    count (or unlisted) -> NULL. Always DOUBLE."""
    event, value, credit = _col(event), _col(value), _col(credit)
    expr = None
    for e in cfg.conversion_events:
        if e.value_mode == "revenue":
            v = value.cast("double") * credit
        elif e.value_mode == "fixed":
            v = F.lit(float(e.fixed_value_usd)) * credit
        else:
            v = F.lit(None).cast("double")
        expr = F.when(event == e.event, v) if expr is None else expr.when(event == e.event, v)
    return expr.otherwise(F.lit(None).cast("double")).cast("double")
