"""Data-driven model: closed-form scoring and ablation against Spark ML."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_events, session_event, conversion_event, us
from tributary.config import AttributionConfig
from tributary.operators import data_driven as dd
from tributary.plans.pipeline import Pipeline


def _toy_compact(spark):
    rows = []
    feats = dd.FEATURES
    for i in range(40):
        flags = [(i >> b) & 1 for b in range(len(feats))]
        label = 1 if (flags[0] or flags[3]) and i % 5 else 0
        rows.append((*flags, label, 1 + i % 3))
    return spark.createDataFrame(rows, ", ".join(f"{f} int" for f in feats) + ", converted int, n bigint")


def test_closed_form_matches_spark_ml_transform(spark):
    from pyspark.ml.classification import LogisticRegressionModel  # noqa: F401
    from pyspark.ml.feature import VectorAssembler
    compact = _toy_compact(spark)
    m = dd.train_model(compact, max_iter=100)
    assert math.isfinite(m.intercept)
    # refit the same way to get a pyspark.ml model, then compare probabilities
    from pyspark.ml.classification import LogisticRegression
    tot = compact.groupBy("converted").agg(F.sum("n").alias("nc")).collect()
    n_all = sum(r.nc for r in tot)
    cw = {r.converted: n_all / (2.0 * r.nc) for r in tot}
    data = compact.withColumn("_w", F.col("n") * F.when(F.col("converted") == 1, cw[1]).otherwise(cw[0]))
    vec = VectorAssembler(inputCols=list(dd.FEATURES), outputCol="_x").transform(
        data.select(*[F.col(f).cast("double") for f in dd.FEATURES], F.col("converted").cast("double"), "_w"))
    ml = LogisticRegression(featuresCol="_x", labelCol="converted", weightCol="_w", maxIter=500, tol=1e-12, regParam=0.0).fit(vec)
    got = vec.withColumn("p_closed", dd.sigmoid(m.logit())).select("p_closed", "_x")
    from pyspark.ml.functions import vector_to_array
    ref = ml.transform(got).select("p_closed", vector_to_array("probability")[1].alias("p_ml")).collect()
    for r in ref:
        assert r.p_closed == pytest.approx(r.p_ml, abs=1e-5)  # two optimisers, one with a trace of a penalty


def test_ablation_in_row_equals_rescoring_with_flag_zeroed(spark):
    m = dd.LogisticModel(-0.5, tuple(0.1 * (i % 5) - 0.2 for i in range(len(dd.FEATURES))))
    c = us(2024, 1, 20, 12)
    rows = [session_event("u", 1, c - 7_200_000_000, "google", "organic"),
            session_event("u", 2, c - 3_600_000_000, "news", "email"),
            session_event("u", 3, c - 1_800_000_000, "partner", "affiliate"),
            conversion_event("u", c, usd=10.0, local=9.0, tid="T")]
    cfg = AttributionConfig(start_date="20240110", end_date="20240131")
    p = Pipeline(make_events(spark, rows), cfg)
    out = {r.channel: r.attributed_credit for r in dd.data_driven(p.journeys, m, cfg).collect()}
    bf = dd.base_features(p.journeys).first().asDict()
    x = [float(bf[f]) for f in dd.FEATURES]
    z = m.intercept + sum(w * xi for w, xi in zip(m.weights, x))
    s = lambda v: 1 / (1 + math.exp(-v))
    eff = {}
    for ch, f, w in zip(dd.FEATURE_CHANNELS, dd.FEATURES, m.weights):
        x0 = [0.0 if ff == f else xi for ff, xi in zip(dd.FEATURES, x)]
        z0 = m.intercept + sum(ww * xi for ww, xi in zip(m.weights, x0))
        eff[ch] = max(s(z) - s(z0), 0.0)
    tot = sum(eff.values())
    expected = {ch: round(e / tot, 6) for ch, e in eff.items() if e > 0}
    assert out == pytest.approx(expected)


def test_class_weights_balance_classes(spark):
    compact = spark.createDataFrame([(1, 1, 30), (0, 0, 10)], "has_paid_search_brand int, converted int, n bigint")
    tot = compact.groupBy("converted").agg(F.sum("n").alias("nc")).collect()
    n_all = sum(r.nc for r in tot)
    w = {r.converted: n_all / (2.0 * r.nc) * r.nc for r in tot}
    assert w[0] == pytest.approx(w[1])  # each class carries half the total weight


def test_pipeline_training_set_and_scoring(spark):
    p = Pipeline.from_fixture(spark, SF_SMALL)
    assert p.train_compact.count() > 0
    dd_rows = p.data_driven
    s = dd_rows.groupBy("conversion_id").agg(F.sum("attributed_credit").alias("s"))
    assert s.where(F.abs(F.col("s") - 1) > 19 * 5e-7).count() == 0
    assert dd_rows.select("conversion_id").distinct().count() == p.journeys.count()


def test_empty_training_table_aborts(spark):
    empty = _toy_compact(spark).limit(0)
    with pytest.raises(ValueError):
        dd.train_model(empty)


def test_both_classes_train_and_a_saved_model_scores_the_same(spark, tmp_path):
    p = Pipeline.from_fixture(spark, SF_SMALL)
    labels = {r.converted: r.n for r in p.train_compact.groupBy("converted").agg(F.sum("n").alias("n")).collect()}
    assert labels[0] > 0 and labels[1] > 0
    m = p.dd_model
    assert math.isfinite(m.intercept) and any(m.weights)
    m.save(spark, str(tmp_path / "model"))
    again = dd.LogisticModel.load(spark, str(tmp_path / "model"))
    assert again == m


def numpy_fit(x, y, w, ridge):
    """Newton on the same objective, features as they are and no standardising."""
    import numpy as np
    m = (w[:, None] * x).sum(axis=0) / w.sum()
    s = np.sqrt((w[:, None] * (x - m) ** 2).sum(axis=0) / w.sum())
    z = np.column_stack([np.ones(len(x)), (x - m) / s])
    pen = np.diag([0.0] + [ridge * w.sum()] * x.shape[1])
    b = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ b))
        b = b + np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + pen, z.T @ (w * (y - p)) - pen @ b)
    return b[0] - (b[1:] / s) @ m, b[1:] / s


def test_newton_on_sums_equals_numpy_on_rows_of_mixed_scales(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 2, 400), rng.normal(300, 90, 400), rng.poisson(4, 400)]).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.8 * x[:, 0] - 0.01 * (x[:, 1] - 300) + 0.2 * (x[:, 2] - 4))))).astype(int)
    w = rng.integers(1, 5, 400).astype(float)
    df = spark.createDataFrame([(*map(float, r), 7.0, int(t), float(v)) for r, t, v in zip(x, y, w)], "a double, b double, c double, same double, y int, w double")
    got, weights, steps = dd.logistic.fit(df.repartition(7), ["a", "b", "same", "c"], "y", "w", dd._stored)
    b0, b = numpy_fit(x, y.astype(float), w, dd.logistic.RIDGE)
    assert got == pytest.approx(b0, rel=1e-8) and steps < 12
    assert weights == pytest.approx([b[0], b[1], 0.0, b[2]], rel=1e-8)


def test_separated_data_have_a_finite_fit(spark):
    rows = [(float(i), int(i >= 5), 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, y int, w double")
    b0, (a,), steps = dd.logistic.fit(df, ["a"], "y", "w", dd._stored)
    assert math.isfinite(b0) and 1 < a < 100 and steps < 50 and -b0 / a == pytest.approx(4.5)
    again = dd.logistic.fit(df.repartition(5), ["a"], "y", "w", dd._stored)
    assert (again[0], again[1][0]) == pytest.approx((b0, a), rel=1e-9)


def test_certificate_of_a_fit_and_of_a_model_that_is_none(spark):
    compact = _toy_compact(spark)
    m = dd.train_model(compact)
    rows = dd.model_certificate(compact, m).collect()
    assert len(rows) == 20 and {r.score for r in rows} == {0.0}
    both = {r.feature: (r.positive_weight, r.negative_weight) for r in rows}[dd.INTERCEPT]
    assert both[0] == pytest.approx(both[1])
    off = dd.LogisticModel(m.intercept + 0.1, m.weights)
    assert any(r.score != 0 for r in dd.model_certificate(compact, off).collect())


def test_features_are_read_once(spark):
    """The stored features are all that the legacy fit goes back to."""
    p = Pipeline.from_fixture(spark, SF_SMALL)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(_):
        reads.add(1)
        return 1

    features = p.sa_features.withColumn("converted", F.col("converted") * seen(F.col("converted")))
    n = dd.training_rows(p.sa_features).count()
    dd.train_model_legacy(features)
    assert reads.value == n
