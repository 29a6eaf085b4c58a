"""Data-driven attribution: logistic regression on channel-presence flags,
then per-conversion removal effects ("feature ablation").

Scale notes:

* The training table is one row per user, but its features are 19 binary
  flags, so it is compacted to one row per distinct (flags, label) with a
  count (at most 2 x 2^19 rows whatever the user count) and fitted as a
  weighted regression -- the same maximum-likelihood problem, so the
  optimiser's per-iteration passes no longer scale with users.
* Negatives (users with sessions and no conversion) come from one grouped
  aggregate over sessions and conversion users (partial aggregation collapses
  heavy users map-side), not from an anti-join.
* Scoring needs only the 20 fitted numbers: they are folded into a Column
  expression, and the 19 ablations are evaluated in-row from the logit
  (``sigmoid(logit - w_i x_i)``) -- no 19 re-scans and no joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MICROS_PER_HOUR, AttributionConfig
from ..functions.channels import FEATURE_CHANNELS, feature_name
from ..functions.conversion import value_expr
from . import logistic
from .models import COUNT_COLUMNS, MART_COLUMNS

FEATURES = tuple(feature_name(c) for c in FEATURE_CHANNELS)
# --- fixed values (model id in the mart, optimiser iteration cap) ---------------
DATA_DRIVEN_MODEL = "data_driven_bqml"
MAX_ITER = 50
INTERCEPT = "__INTERCEPT__"
# ------------------------------------------------------------------------------


def _flags_from_channel(channel: Column) -> list[Column]:
    return [(channel == c).cast("int").alias(f) for c, f in zip(FEATURE_CHANNELS, FEATURES)]


def _flags_from_path(channels: Column) -> list[Column]:
    """19 flags from the array of a journey's channels."""
    return [F.array_contains(channels, c).cast("int").alias(f) for c, f in zip(FEATURE_CHANNELS, FEATURES)]


def train_set(journeys_df: DataFrame, sessions_df: DataFrame, conversions_df: DataFrame) -> DataFrame:
    """Positives: users with attributed journeys, flags = channel seen on any
    path. Negatives: users with sessions and no conversion at all."""
    pos_rows = journeys_df.select("user_pseudo_id", *_flags_from_path(F.col("path.channel")))
    pos = pos_rows.groupBy("user_pseudo_id").agg(*[F.max(f).alias(f) for f in FEATURES]) \
        .withColumn("converted", F.lit(1))
    s = sessions_df.select("user_pseudo_id", *_flags_from_channel(F.col("channel")), F.lit(0).alias("_conv"))
    c = conversions_df.select("user_pseudo_id", *[F.lit(0).alias(f) for f in FEATURES], F.lit(1).alias("_conv"))
    both = s.unionByName(c).groupBy("user_pseudo_id").agg(
        *[F.max(f).alias(f) for f in FEATURES], F.max("_conv").alias("_conv"),
        F.max(F.lit(1) - F.col("_conv")).alias("_has_session"))
    neg = both.where((F.col("_conv") == 0) & (F.col("_has_session") == 1)) \
        .select("user_pseudo_id", *FEATURES, F.lit(0).alias("converted"))
    return pos.unionByName(neg).select(*FEATURES, "converted")


def compact_train_set(train: DataFrame) -> DataFrame:
    """One row per distinct (flags, label) with its multiplicity."""
    return train.groupBy(*FEATURES, "converted").agg(F.count(F.lit(1)).alias("n"))


def assert_non_empty(compact: DataFrame):
    """Abort before fitting on an empty training table."""
    if compact.isEmpty():
        raise ValueError("training table is empty: check start_date / end_date")


@dataclass(frozen=True)
class LogisticModel:
    intercept: float
    weights: tuple[float, ...]
    features: tuple[str, ...] = FEATURES

    def logit(self, cols: list[Column] | None = None) -> Column:
        cols = cols or [F.col(f) for f in self.features]
        z = F.lit(float(self.intercept))
        for w, c in zip(self.weights, cols):
            z = z + F.lit(float(w)) * c.cast("double")
        return z

    def rounded(self, digits: int) -> LogisticModel:
        """The model with its numbers rounded, as it is reported and saved."""
        return LogisticModel(round(self.intercept, digits), tuple(round(w, digits) for w in self.weights), self.features)

    def save(self, spark, path: str) -> None:
        """Write the fitted numbers under ``path`` (a named model)."""
        rows = [(i, f, float(w)) for i, (f, w) in enumerate(zip(self.features, self.weights))] + [(-1, INTERCEPT, float(self.intercept))]
        spark.createDataFrame(rows, "position int, feature string, weight double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> LogisticModel:
        """Read a model that :meth:`save` wrote (one row per feature)."""
        rows = spark.read.parquet(path).orderBy("position").collect()
        return LogisticModel(rows[0]["weight"], tuple(r["weight"] for r in rows[1:]), tuple(r["feature"] for r in rows[1:]))

    def weights_frame(self, spark) -> DataFrame:
        rows = [(f, float(w)) for f, w in zip(self.features, self.weights)] + [(INTERCEPT, float(self.intercept))]
        df = spark.createDataFrame(rows, "feature string, weight double")
        return df.orderBy(F.abs("weight").desc(), "feature")


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _stored(df: DataFrame) -> DataFrame:
    """Written to the cluster's shared folder and read back."""
    import uuid

    from ..plans.session import shared_dir, stored
    return stored(df, f"{shared_dir(df.sparkSession)}/training/{uuid.uuid4().hex}")


def class_weighted(compact: DataFrame, label: str = "converted") -> DataFrame:
    """The compact table with ``_w``: the multiplicity times N / (2 N_class)."""
    tot = compact.groupBy(label).agg(F.sum("n").alias("_nc"))
    n_all = F.sum("_nc").over(Window.partitionBy())  # over the 2 class rows
    cw = tot.select(label, (n_all / (F.lit(2.0) * F.col("_nc"))).alias("_cw"))
    # cw has one row per class (2 rows): broadcast is bounded by construction
    return compact.join(F.broadcast(cw), label).withColumn("_w", F.col("n") * F.col("_cw"))


def train_model(compact: DataFrame, max_iter: int = MAX_ITER, auto_class_weights: bool = True,
                features=FEATURES, label: str = "converted") -> LogisticModel:
    """Weighted logistic regression (no regularisation). With
    ``auto_class_weights`` each class is weighted by N / (2 N_class). The
    compact table (at most 2 x 2^19 rows) is stored first, so no step of the
    fit, and no retry after an executor loss, recomputes the journeys."""
    compact = _stored(compact)
    assert_non_empty(compact)
    data = class_weighted(compact, label) if auto_class_weights else compact.withColumn("_w", F.col("n").cast("double"))
    intercept, weights, _ = logistic.fit(data, list(features), label, "_w", _stored, max_iter)
    return LogisticModel(intercept, tuple(weights), tuple(features))


def model_certificate(compact: DataFrame, model: LogisticModel, label: str = "converted", auto_class_weights: bool = True) -> DataFrame:
    """What a fit must satisfy: by feature (and for the intercept) the score
    equation sum w (y - p) x, as a share of the total weight and rounded, and the
    weight of the positive and the negative rows that have the feature."""
    data = class_weighted(compact, label) if auto_class_weights else compact.withColumn("_w", F.col("n").cast("double"))
    p = sigmoid(model.logit())
    named = [(f, F.col(f).cast("double")) for f in model.features] + [(INTERCEPT, F.lit(1.0))]
    rows = data.select(F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), x.alias("x")) for n, x in named])).alias("e"),
                       "_w", F.col(label).cast("double").alias("_y"), p.alias("_p"))
    x = F.col("e.x")
    total = data.agg(F.sum("_w")).scalar()
    agg = rows.groupBy(F.col("e.feature").alias("feature")).agg(
        F.sum(F.col("_w") * (F.col("_y") - F.col("_p")) * x).alias("_s"),
        F.sum(F.when(x != 0, F.col("_w") * F.col("_y"))).alias("_pos"), F.sum(F.when(x != 0, F.col("_w") * (1 - F.col("_y")))).alias("_neg"))
    # + 0.0: a rounded negative zero is a zero
    return agg.select("feature", (F.round(F.col("_s") / total, 5) + F.lit(0.0)).alias("score"),
                      F.round(F.coalesce("_pos", F.lit(0.0)), 6).alias("positive_weight"), F.round(F.coalesce("_neg", F.lit(0.0)), 6).alias("negative_weight"))


def model_evaluate(compact: DataFrame, model: LogisticModel, label: str = "converted") -> DataFrame:
    """Predicted label (p >= 0.5) vs actual conversion rate."""
    p = sigmoid(model.logit())
    return compact.groupBy((p >= 0.5).cast("int").alias("predicted_converted_label")).agg(
        (F.sum(F.col("n") * F.col(label)) / F.sum("n")).alias("actual_conversion_rate"),
        F.sum("n").alias("rows"))


def base_features(journeys_df: DataFrame) -> DataFrame:
    """Per conversion: 19 flags from its path; dimensions from the first touch."""
    first = F.col("path")[0]
    return journeys_df.select(
        "user_pseudo_id", "conversion_id", "conversion_event", "conversion_value_usd", "conversion_value_local",
        "conversion_ts", "transaction_id", "path_length",
        first["source"].alias("source"), first["medium"].alias("medium"), first["campaign"].alias("campaign"),
        *_flags_from_path(F.col("path.channel")),
    )


def removal_shares(flagged: DataFrame, model: LogisticModel) -> tuple[DataFrame, Column]:
    """Rows with the 19 flags -> a row for each credited channel (``_e.channel``,
    its place ``_at``) with the other columns, and the Column of the credit.
    effect_c = max(p_all - p_without_c, 0); share = effect / sum(effects), or
    1/19 to every channel when all effects are 0; zero shares dropped; ROUND(share, 6)."""
    z = model.logit()
    n = len(FEATURE_CHANNELS)
    chans = F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(float(w)).alias("w"),
                               F.col(f).cast("double").alias("x"))
                      for c, f, w in zip(FEATURE_CHANNELS, model.features, model.weights)])
    scored = flagged.select(*[c for c in flagged.columns if c not in FEATURES], z.alias("_z"), chans.alias("_ch"))
    eff = F.transform(F.col("_ch"), lambda e: F.struct(
        e["channel"].alias("channel"),
        F.greatest(sigmoid(F.col("_z")) - sigmoid(F.col("_z") - e["w"] * e["x"]), F.lit(0.0)).alias("eff")))
    s = scored.select(*[c for c in scored.columns if c not in ("_z", "_ch")], eff.alias("_eff"))
    s = s.withColumn("_tot", F.aggregate("_eff", F.lit(0.0), lambda acc, e: acc + e["eff"]))
    keep = F.filter("_eff", lambda e: (e["eff"] > 0) | (F.col("_tot") == 0))
    e = s.select(*[c for c in s.columns if c not in ("_eff",)], F.posexplode(keep).alias("_at", "_e"))
    return e, F.round(F.when(F.col("_tot") == 0, F.lit(1.0 / n)).otherwise(F.col("_e.eff") / F.col("_tot")), 6)


def data_driven(journeys_df: DataFrame, model: LogisticModel, cfg: AttributionConfig) -> DataFrame:
    """Removal-effect attribution (``removal_shares``), with the mart's count columns."""
    e, credit = removal_shares(base_features(journeys_df), model)
    return e.select(
        "user_pseudo_id", "conversion_id", "conversion_ts", "conversion_event", "transaction_id",
        "conversion_value_local", "conversion_value_usd", "path_length", "source", "medium", "campaign",
        F.col("_e.channel").alias("channel"), F.lit(DATA_DRIVEN_MODEL).alias("model"),
        credit.alias("attributed_credit"),
        value_expr("conversion_event", "conversion_value_usd", credit, cfg).alias("attributed_value_usd"),
        value_expr("conversion_event", "conversion_value_local", credit, cfg).alias("attributed_value_local"),
        F.lit(1).alias("first_of_channel"), (F.col("_at") == 0).cast("int").alias("first_of_model"),
    ).select(*MART_COLUMNS, *COUNT_COLUMNS)


# ---- stand-alone (legacy) variant -------------------------------------------------

# --- fixed values (stand-alone script: flag column -> reported channel label) ---
LEGACY_FLAGS = (
    ("has_organic", "Organic Search"), ("has_cpc", "Paid Search (CPC)"), ("has_social", "Social"),
    ("has_email", "Email"), ("has_display", "Display"), ("has_referral", "Referral"),
    ("has_affiliate", "Affiliate"), ("has_direct", "Direct"),
)
# Coefficient interpretation texts of the feature-importance report.
INTERPRETATION_POSITIVE = "Positive driver — having this channel increases P(conversion)"
INTERPRETATION_NEGATIVE = "Negative driver — having this channel decreases P(conversion)"
INTERPRETATION_NONE = "No effect"
# ------------------------------------------------------------------------------
LEGACY_FEATURES = ("touchpoint_count", "distinct_channels", *[f for f, _ in LEGACY_FLAGS], "journey_hours")


def _legacy_flag_exprs(medium: Column) -> list[Column]:
    lm = F.lower(medium)
    conds = {
        "has_organic": medium == "organic",
        "has_cpc": lm.isin("cpc", "ppc", "paidsearch"),
        "has_social": lm.contains("social"),
        "has_email": medium == "email",
        "has_display": medium.isin("display", "banner"),
        "has_referral": medium == "referral",
        "has_affiliate": medium == "affiliate",
        "has_direct": F.coalesce(medium, F.lit("(none)")).isin("(none)", ""),
    }
    return [F.when(conds[f], 1).otherwise(0).alias(f) for f, _ in LEGACY_FLAGS]


def journey_features(events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Per (user, converted): touch count, distinct source/medium pairs, 8
    medium flags and journey span in hours, over every event in the window.

    Semantics of the stand-alone script: each touch is paired with every
    later-or-equal purchase of the user; touches with none form the
    ``converted = 0`` row, the others the ``converted = 1`` row, and touch
    counts multiply by the number of later purchases. Rather than emitting
    those pairs, touches and purchases are first summed per (user, instant,
    source, medium), combined before the shuffle; each such row then gets its
    multiplicity m = later purchases, from (a) purchases at or after it in its
    time bucket (window per user and bucket) plus (b) purchases in later
    buckets (suffix sum over a count table). Only a user's minute
    (``cfg.number_bucket_seconds``) is ever one window partition.
    """
    ev = events.where(F.col("user_pseudo_id").isNotNull())
    W = Window
    t = ev.groupBy("user_pseudo_id", "event_timestamp", "source", "medium").agg(
        F.count(F.lit(1)).alias("_n"), F.sum((F.col("event_name") == "purchase").cast("long")).alias("_p"))
    t = t.withColumn("_day", F.floor(F.col("event_timestamp") / F.lit(cfg.number_bucket_micros)).cast("long"))
    same_day = W.partitionBy("user_pseudo_id", "_day").orderBy("event_timestamp") \
        .rangeBetween(0, W.unboundedFollowing)
    per_day = t.groupBy("user_pseudo_id", "_day").agg(F.sum("_p").alias("_pd"))
    t = t.withColumn("_m_same", F.coalesce(F.sum("_p").over(same_day), F.lit(0)))
    later = W.partitionBy("user_pseudo_id").orderBy("_day").rowsBetween(1, W.unboundedFollowing)
    per_day = per_day.select("user_pseudo_id", "_day", F.coalesce(F.sum("_pd").over(later), F.lit(0)).alias("_m_later"))
    t = t.join(per_day, ["user_pseudo_id", "_day"], "inner")
    m = F.col("_m_same") + F.col("_m_later")
    t = t.withColumn("converted", (m > 0).cast("int")).withColumn("_mult", F.when(m > 0, m).otherwise(F.lit(1)))
    agg = t.groupBy("user_pseudo_id", "converted").agg(
        F.sum(F.col("_mult") * F.col("_n")).alias("touchpoint_count"),
        F.countDistinct(F.concat(F.col("source"), F.lit(" / "), F.col("medium"))).alias("distinct_channels"),
        F.max(F.col("event_timestamp")).alias("_mx"), F.min(F.col("event_timestamp")).alias("_mn"),
        *[F.max(e).alias(f) for e, (f, _) in zip(_legacy_flag_exprs(F.col("medium")), LEGACY_FLAGS)],
    )
    return agg.select(
        "user_pseudo_id", "converted", "touchpoint_count", "distinct_channels", *[f for f, _ in LEGACY_FLAGS],
        F.round((F.col("_mx") - F.col("_mn")) / F.lit(float(MICROS_PER_HOUR)), 2).alias("journey_hours"),
    )


def training_rows(features_df: DataFrame, seed: int = 42, train_fraction: float = 0.8) -> DataFrame:
    """The training split, by a digest of the user id (the script's automatic
    split; the same whatever the partitioning and the engine)."""
    digest = F.conv(F.substring(F.md5(F.concat(F.col("user_pseudo_id").cast("string"), F.lit(f"-{seed}"))), 1, 8), 16, 10).cast("long")
    return features_df.where(digest % 1000 < int(1000 * train_fraction))


def train_model_legacy(features_df: DataFrame, seed: int = 42, train_fraction: float = 0.8,
                       max_iter: int = MAX_ITER) -> LogisticModel:
    """11-feature logistic regression, unweighted, on the training split. The
    features are stored first: they are computed once."""
    rows = _stored(training_rows(features_df, seed, train_fraction).select(*LEGACY_FEATURES, "converted", F.lit(1.0).alias("_w")))
    intercept, weights, _ = logistic.fit(rows, list(LEGACY_FEATURES), "converted", "_w", _stored, max_iter)
    return LogisticModel(intercept, tuple(weights), LEGACY_FEATURES)


def feature_importance(model: LogisticModel, spark) -> DataFrame:
    rows = [(f, round(float(w), 4)) for f, w in zip(model.features, model.weights)]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    interp = (F.when(F.col("coefficient") > 0, INTERPRETATION_POSITIVE)
              .when(F.col("coefficient") < 0, INTERPRETATION_NEGATIVE)
              .otherwise(INTERPRETATION_NONE))
    return df.withColumn("interpretation", interp).orderBy(F.abs("coefficient").desc(), "feature")


def data_driven_legacy(features_df: DataFrame, model: LogisticModel) -> DataFrame:
    """Per converting user, ablate each of the 8 flags in-row, normalise the
    positive contributions to shares, and sum shares per channel."""
    conv = features_df.where(F.col("converted") == 1)
    z = model.logit()
    p = sigmoid(z)
    idx = {f: i for i, f in enumerate(model.features)}
    contribs = []
    for f, label in LEGACY_FLAGS:
        w = float(model.weights[idx[f]])
        contribs.append(F.greatest(p - sigmoid(z - F.lit(w) * F.col(f).cast("double")), F.lit(0.0)).alias(f"_c_{f}"))
    s = conv.select(*contribs)
    tot = None
    for f, _ in LEGACY_FLAGS:
        tot = F.col(f"_c_{f}") if tot is None else tot + F.col(f"_c_{f}")
    arr = F.array(*[F.struct(F.lit(label).alias("channel"),
                             (F.col(f"_c_{f}") / F.when(tot != 0, tot)).alias("share"))
                    for f, label in LEGACY_FLAGS])
    e = s.select(F.explode(arr).alias("x"))
    return e.groupBy(F.col("x.channel").alias("channel")).agg(
        F.round(F.sum(F.col("x.share").cast("decimal(38,10)")), 4).cast("double").alias("attributed_conversions"))


def channel_volume(events: DataFrame, cfg: AttributionConfig, top: int | None = 50) -> DataFrame:
    """source / medium: distinct users, purchase events, pct of purchases."""
    ev = events.where(F.col("user_pseudo_id").isNotNull())
    agg = ev.groupBy(F.concat(F.col("source"), F.lit(" / "), F.col("medium")).alias("channel")).agg(
        F.countDistinct("user_pseudo_id").alias("users"),
        F.count(F.when(F.col("event_name") == "purchase", 1)).alias("conversions"))
    # the total is one row by itself: no window over all source/medium pairs
    tot = ev.agg(F.count(F.when(F.col("event_name") == "purchase", 1)).alias("_t")).scalar()
    out = agg.select("channel", "users", "conversions",
                     F.round(F.try_divide(F.col("conversions").cast("double") * 100.0,
                                          F.nullif(tot, F.lit(0)).cast("double")), 2).alias("pct"))
    out = out.orderBy(F.col("conversions").desc(), F.col("channel").asc_nulls_first())
    return out.limit(top) if top else out
