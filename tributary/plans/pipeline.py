"""The attribution pipeline as lazily composed DataFrames.

``Pipeline`` wires the staging -> intermediate -> model -> mart layers. Each
layer is built once per Pipeline object (``cached_property``); nothing is
collected and nothing is kept in executors' memory.

Layers that are read more than once (matched journeys before numbering, the
single-touch timeline, stand-alone journeys) are written to the session's
shared checkpoint folder when first used and read back: computed once, lineage
cut, safe when executors are lost. :meth:`materialize` does the same for any
other layer, :meth:`cleanup` deletes what this pipeline has written.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG, AttributionConfig
from ..operators import channel_credits as credit_ops
from ..operators import conversions as conv_ops
from ..operators import cost as cost_ops
from ..operators import data_driven as dd_ops
from ..operators import journeys as journey_ops
from ..operators import models as model_ops
from ..operators import reports as report_ops
from ..operators import sessions as session_ops
from ..operators import single_touch as single_ops
from ..sources.cost import fixture_cost_by_platform
from ..sources.events import filter_event_dates, flatten_events, read_events
from ..sources.fixtures import fixture_events
from ..sources.shards import read_sharded_events
from .session import delete_path, shared_dir, stored

# Stand-alone scripts run over the whole fixture month.
STANDALONE_FIXTURE_CONFIG = AttributionConfig(start_date="20240101", end_date="20240131").standalone()


class Pipeline:
    """Composable pipeline over a flat event DataFrame."""

    def __init__(self, events_flat: DataFrame, cfg: AttributionConfig = FIXTURE_CONFIG,
                 standalone_cfg: AttributionConfig | None = None):
        self.events = events_flat
        self.cfg = cfg
        self.sa_cfg = standalone_cfg or cfg.standalone()
        self.spark = events_flat.sparkSession
        # materialised layers of this run go to <checkpoint dir>/layers/<run_id>/
        self.run_id = f"{cfg.start_date}-{cfg.end_date}-{uuid.uuid4().hex[:12]}"

    # -- constructors ------------------------------------------------------
    @classmethod
    def from_export(cls, spark: SparkSession, path: str, cfg: AttributionConfig, fmt: str = "parquet") -> Pipeline:
        """Nested export partitioned by ``event_date`` (partition-pruned scan)."""
        return cls(flatten_events(read_events(spark, path, cfg, fmt), cfg), cfg)

    @classmethod
    def from_shards(cls, spark: SparkSession, root: str, cfg: AttributionConfig, fmt: str = "parquet") -> Pipeline:
        """Nested export with one table for each day (only days of the scan are opened)."""
        return cls(read_sharded_events(spark, root, cfg, fmt), cfg)

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, cfg: AttributionConfig = FIXTURE_CONFIG) -> Pipeline:
        """The driver's synthetic event table, mapped per FIXTURES.md, with
        the cost fixture as the three platform inputs."""
        p = cls(fixture_events(spark, sf_dir), cfg, standalone_cfg=STANDALONE_FIXTURE_CONFIG)
        p._cost_source = lambda: fixture_cost_by_platform(spark, sf_dir)
        return p

    # -- staging -----------------------------------------------------------
    @cached_property
    def scanned(self) -> DataFrame:
        return filter_event_dates(self.events, self.cfg)

    @cached_property
    def sessions(self) -> DataFrame:
        return session_ops.sessions(self.scanned, self.cfg)

    @cached_property
    def conversions(self) -> DataFrame:
        return conv_ops.conversions(self.scanned, self.cfg)

    # -- intermediate ------------------------------------------------------
    @cached_property
    def journeys(self) -> DataFrame:
        """Journeys with the path fields that models and reports read."""
        return journey_ops.numbered(self.matched, self.cfg)

    @cached_property
    def matched(self) -> DataFrame:
        """The stored journeys before their numbering."""
        return self._store("matched")(journey_ops.matched(self.sessions, self.conversions, self.cfg, journey_ops.MODEL_FIELDS))

    @cached_property
    def journeys_full(self) -> DataFrame:
        """Journeys whose path carries all 26 session fields."""
        return journey_ops.journeys(self.sessions, self.conversions, self.cfg, store=self._store("matched_full"))

    @cached_property
    def path_rows(self) -> DataFrame:
        return journey_ops.path_rows(self.journeys_full)

    # -- models ------------------------------------------------------------
    @cached_property
    def rule_mart(self) -> DataFrame:
        """The seven rule-based models (one pass over journeys)."""
        return model_ops.attribution_mart(self.journeys, self.cfg)

    def model(self, name: str) -> DataFrame:
        """One model's rows; the single-touch ones without any path."""
        if name in single_ops.SINGLE_TOUCH_MODELS:
            return self.single_touch.where(F.col("model") == name)
        return model_ops.single_model(self.journeys, self.cfg, name)

    @cached_property
    def single_touch(self) -> DataFrame:
        return single_ops.single_touch(self.sessions, self.conversions, self.cfg, store=self._store("single"))

    # -- data-driven model --------------------------------------------------
    @cached_property
    def train_set(self) -> DataFrame:
        return dd_ops.train_set(self.journeys, self.sessions, self.conversions)

    @cached_property
    def train_compact(self) -> DataFrame:
        return dd_ops.compact_train_set(self.train_set)

    @cached_property
    def dd_model(self) -> dd_ops.LogisticModel:
        """Fitted once per pipeline (an action: iterative optimiser). Set it to
        a loaded model (``LogisticModel.load``) to score without fitting."""
        return dd_ops.train_model(self.train_compact)

    @cached_property
    def _data_driven(self) -> DataFrame:
        return dd_ops.data_driven(self.journeys, self.dd_model, self.cfg)

    @cached_property
    def data_driven(self) -> DataFrame:
        return self._data_driven.select(*model_ops.MART_COLUMNS)

    @cached_property
    def counted(self) -> DataFrame:
        """All eight models with the count columns that reports sum."""
        return model_ops.counted_mart(self.journeys, self.cfg, self._data_driven)

    @cached_property
    def mart(self) -> DataFrame:
        """All eight models (seven rule-based + data-driven)."""
        return self.counted.select(*model_ops.MART_COLUMNS)

    # -- marts and reports ---------------------------------------------------
    @cached_property
    def cross_channel(self) -> DataFrame:
        return credit_ops.cross_channel_of_days(self.channel_totals)

    @cached_property
    def channel_totals(self) -> DataFrame:
        """Stored totals of the credits by day, model, event and channel."""
        return self._store("totals")(credit_ops.daily_totals(self.channel_credits, self.cfg))

    @cached_property
    def channel_credits(self) -> DataFrame:
        """Credits of all eight models by conversion and channel, without paths or pairs."""
        return credit_ops.channel_credits(self.sessions, self.conversions, self.cfg, self.dd_model, self._store("credits"))

    @cached_property
    def cross_channel_of_mart(self) -> DataFrame:
        """The same report from the mart's rows."""
        return report_ops.cross_channel(self.counted, self.cfg)

    @cached_property
    def dashboard(self) -> DataFrame:
        return report_ops.attribution_dashboard(self.mart, self.cfg)

    @cached_property
    def traffic(self) -> DataFrame:
        return report_ops.daily_traffic_overview(self.sessions)

    @cached_property
    def funnel(self) -> DataFrame:
        return report_ops.purchase_funnel(self.conversions)

    @cached_property
    def abandonment(self) -> DataFrame:
        return report_ops.cart_abandonment(self.conversions)

    @cached_property
    def path_analysis(self) -> DataFrame:
        """Paths need no numbers: from the journeys before numbering."""
        return report_ops.path_analysis(self.matched.withColumnRenamed("purchase_revenue_in_usd", "conversion_value_usd"), store=self._store("paths"))

    # -- cost --------------------------------------------------------------
    _cost_source = None

    @cached_property
    def cost_platforms(self) -> tuple:
        """(google, meta, other) cost tables; built on first use."""
        if self._cost_source is None:
            raise ValueError("no cost inputs: set Pipeline.cost_platforms = (google, meta, other)")
        return self._cost_source()

    @cached_property
    def unified_cost(self) -> DataFrame:
        if self.cost_platforms is None:
            raise ValueError("no cost inputs: set Pipeline.cost_platforms = (google, meta, other)")
        return cost_ops.unified_cost(*self.cost_platforms)

    @cached_property
    def roas(self) -> DataFrame:
        return cost_ops.roas(self.channel_totals.withColumnRenamed("_usd", "_value").drop("_local"), self.unified_cost)

    # -- stand-alone layer -------------------------------------------------
    @cached_property
    def sa_events(self) -> DataFrame:
        return filter_event_dates(self.events, self.sa_cfg)

    @cached_property
    def sa_sessions(self) -> DataFrame:
        return session_ops.sessions_first_non_auto(self.sa_events, self.sa_cfg)

    @cached_property
    def sa_conversions(self) -> DataFrame:
        return conv_ops.conversions_purchase(self.sa_events, self.sa_cfg)

    @cached_property
    def sa_journeys(self) -> DataFrame:
        return self._store("sa_journeys")(journey_ops.journeys_exact30(
            self.sa_sessions, self._store("sa_conversions")(self.sa_conversions), self.sa_cfg))

    @cached_property
    def sa_path_rows(self) -> DataFrame:
        return journey_ops.path_rows_standalone(self.sa_journeys)

    @cached_property
    def sa_features(self) -> DataFrame:
        return dd_ops.journey_features(self.sa_events, self.sa_cfg)

    @cached_property
    def sa_model(self) -> dd_ops.LogisticModel:
        return dd_ops.train_model_legacy(self.sa_features)

    # -- materialisation ---------------------------------------------------
    @property
    def _layers(self) -> str:
        return f"{shared_dir(self.spark)}/layers/{self.run_id}"

    def _store(self, name: str):
        """A function that stores each frame given to it as its own layer."""
        done = iter(range(1 << 30))
        return lambda df: stored(df, f"{self._layers}/{name}-{next(done)}")

    def materialize(self, name: str) -> DataFrame:
        """Write layer ``name`` to the shared checkpoint folder and replace it
        by the re-read table. Materialise a layer before reading the layers
        built on it."""
        out = stored(getattr(self, name), f"{self._layers}/{name}")
        self.__dict__[name] = out
        return out

    def cleanup(self) -> None:
        """Delete the layers of this pipeline; its frames can't be read after."""
        delete_path(self.spark, self._layers)
