"""Run configuration: conversion events, date window, taxonomy and options.

Everything here is plain driver-side Python; it is folded into Column
expressions (constant folding happens in Catalyst), never shipped as data.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta, timezone

# --- fixed values (must equal the reference's defaults) -----------------------
# Conversion events: (event, value_mode, value_field, fixed_value_usd, lookback_days)
DEFAULT_CONVERSION_EVENTS_SPEC = (
    ("purchase", "revenue", "purchase_revenue_in_usd", None, 30),
    ("begin_checkout", "count", None, None, 14),
    ("add_to_cart", "count", None, None, 7),
    ("add_shipping_info", "count", None, None, 7),
    ("add_payment_info", "count", None, None, 7),
)
# Lookback for an event not in the list, and value mode for it.
UNLISTED_LOOKBACK_DAYS = 30
UNLISTED_VALUE_MODE = "count"
# Brand regex used to split paid search into brand / non-brand.
DEFAULT_BRAND_REGEX = "your-brand-here|yourbrand"
# Reference default run window.
DEFAULT_START_DATE = "20201101"
DEFAULT_END_DATE = "20210131"
# Source resolution modes.
SOURCE_MODES = ("event_params", "session_stslc", "collected", "auto")
# Time-decay half-life (hours) of the pipeline, and the stand-alone decay.
HALF_LIFE_HOURS = 168.0
STANDALONE_DECAY_RATE = 0.00412
STANDALONE_DECAY_CAP_HOURS = 168
STANDALONE_LOOKBACK_DAYS = 30
# ------------------------------------------------------------------------------

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


@dataclass(frozen=True)
class ConversionEvent:
    event: str
    value_mode: str = "count"  # 'revenue' | 'fixed' | 'count'
    value_field: str | None = None  # documented only: the caller's column decides
    fixed_value_usd: float | None = None
    lookback_days: int = 30


DEFAULT_CONVERSION_EVENTS = tuple(ConversionEvent(*spec) for spec in DEFAULT_CONVERSION_EVENTS_SPEC)


def _parse_yyyymmdd(s: str) -> date:
    return datetime.strptime(s, "%Y%m%d").date()


@dataclass(frozen=True)
class AttributionConfig:
    """All knobs of one attribution run.

    Pipeline semantics are the default; stand-alone variants are options:
    ``lookback_mode='exact'`` (s >= c - L days) instead of whole-day
    truncation, ``end_inclusive=True`` to keep events of ``end_date`` itself.
    """

    start_date: str = DEFAULT_START_DATE
    end_date: str = DEFAULT_END_DATE
    conversion_events: tuple[ConversionEvent, ...] = DEFAULT_CONVERSION_EVENTS
    brand_regex: str = DEFAULT_BRAND_REGEX
    source_mode: str = "event_params"
    has_privacy_info: bool = False
    exclude_modeled_events: bool = False
    end_inclusive: bool = False
    lookback_mode: str = "whole_days"  # or 'exact'
    round_credit: bool = True
    widen_scan: bool = True  # scan start - max lookback (False = stand-alone truncation)
    # Width of the time buckets of the lookback join, in days; None: as wide as
    # the longest window, so that a conversion has at most two copies. Skewed
    # buckets are split by the adaptive skew join.
    join_bucket_days: int | None = None
    # Width of the time buckets in which a user's conversions are numbered.
    number_bucket_seconds: int = 60
    extra: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        if self.source_mode not in SOURCE_MODES:
            raise ValueError(f"source_mode must be one of {SOURCE_MODES}, got {self.source_mode!r}")
        if self.lookback_mode not in ("whole_days", "exact"):
            raise ValueError("lookback_mode must be 'whole_days' or 'exact'")
        if not self.conversion_events:
            raise ValueError("at least one conversion event is required")
        if self.number_bucket_seconds < 1 or (self.join_bucket_days is not None and self.join_bucket_days < 1):
            raise ValueError("bucket widths must be positive")
        _parse_yyyymmdd(self.start_date)
        _parse_yyyymmdd(self.end_date)

    def with_(self, **kw) -> AttributionConfig:
        return replace(self, **kw)

    # -- derived values (driver-side literals) --------------------------------
    @property
    def event_names(self) -> list[str]:
        return [e.event for e in self.conversion_events]

    @property
    def max_lookback(self) -> int:
        return max(e.lookback_days for e in self.conversion_events)

    @property
    def join_bucket_micros(self) -> int:
        return (self.join_bucket_days or self.max_lookback + 1) * MICROS_PER_DAY

    @property
    def number_bucket_micros(self) -> int:
        return self.number_bucket_seconds * 1_000_000

    def events_by_mode(self, mode: str) -> list[str]:
        return [e.event for e in self.conversion_events if e.value_mode == mode]

    @property
    def start(self) -> date:
        return _parse_yyyymmdd(self.start_date)

    @property
    def end(self) -> date:
        return _parse_yyyymmdd(self.end_date)

    @property
    def scan_start_date(self) -> str:
        """Lowest ``event_date`` partition read (start minus max lookback)."""
        if not self.widen_scan:
            return self.start_date
        return (self.start - timedelta(days=self.max_lookback)).strftime("%Y%m%d")

    @staticmethod
    def _micros(d: date) -> int:
        return int(datetime(d.year, d.month, d.day, tzinfo=timezone.utc).timestamp()) * 1_000_000

    @property
    def start_micros(self) -> int:
        return self._micros(self.start)

    @property
    def session_start_micros(self) -> int:
        """Lower bound on session event time: start minus the longest lookback
        (or start itself when the scan is not widened)."""
        widen = self.max_lookback * MICROS_PER_DAY if self.widen_scan else 0
        return self.start_micros - widen

    @property
    def end_micros(self) -> int:
        """Upper bound (inclusive) on event time: 00:00 of end_date, as the
        reference does, or the last microsecond of it with ``end_inclusive``."""
        base = self._micros(self.end)
        return base + MICROS_PER_DAY - 1 if self.end_inclusive else base


    def standalone(self) -> AttributionConfig:
        """Stand-alone script semantics: scan [start, end] only (lookback is
        truncated at start), whole end day included, exact 30-day window."""
        return replace(self, widen_scan=False, end_inclusive=True, lookback_mode="exact")


# The run window used for the driver's synthetic event table (FIXTURES.md §2).
FIXTURE_CONFIG = AttributionConfig(start_date="20240115", end_date="20240131")
