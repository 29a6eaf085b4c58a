"""Weighted logistic regression by Newton steps on sums that Spark takes.

A step needs the score (gradient) and the Gram matrix of the weighted features.
Every task takes them over its stored training rows, Spark adds them up, and
what reaches the driver is (k + 1)(k + 2) numbers for k features, whatever the
number of rows. Features are standardised by sums of the same kind, so that
hours and flags are of one scale.

There is no penalty but a trace (``RIDGE`` of the total weight on the squared
standardised weights), which moves a fit by less than it is reported with, and
gives data that a plane separates a solution at all: any fit is the one point
where the score equations hold, whatever the engine or the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (the oracle repeats them) -------------------------------------
RIDGE = 1e-7
#: Share of the total weight to which every score equation must hold.
TOLERANCE = 1e-12
MAX_STEPS = 50
# ------------------------------------------------------------------------------


def moments(data: DataFrame, features: list[str], weight: str) -> tuple[float, list[float], list[float]]:
    """Total weight, means and standard deviations (0 for a constant feature)."""
    w = F.col(weight)
    first = data.agg(F.sum(w).alias("w"), *[F.sum(w * F.col(f)).alias(f"m{i}") for i, f in enumerate(features)],
                     *[(F.max(f) > F.min(f)).alias(f"v{i}") for i, f in enumerate(features)]).first()
    total = float(first["w"])
    means = [float(first[f"m{i}"]) / total for i in range(len(features))]
    second = data.agg(*[F.sum(w * (F.col(f) - F.lit(m)) * (F.col(f) - F.lit(m))).alias(f"s{i}") for i, (f, m) in enumerate(zip(features, means))]).first()
    return total, means, [math.sqrt(float(second[f"s{i}"]) / total) if first[f"v{i}"] else 0.0 for i in range(len(features))]


def design(data: DataFrame, features: list[str], label: str, weight: str, means: list[float], sds: list[float]) -> DataFrame:
    """x (1 and the standardised features), y, w."""
    cols = [(F.col(f).cast("double") - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0) for f, m, s in zip(features, means, sds)]
    return data.select(F.array(F.lit(1.0), *cols).alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"))


def sums(rows: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score and Gram matrix at ``beta``, summed by task, then by Spark."""
    k = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            y, w = (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -700, 700)))
            total[:, :k] += (x * (w * p * (1 - p))[:, None]).T @ x
            total[:, k] += x.T @ (w * (y - p))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * (k + 1))), pa.array(total.ravel())], ["at", "part"])

    got = dict(rows.mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("part")).collect())
    m = np.array([got.get(i, 0.0) for i in range(k * (k + 1))]).reshape(k, k + 1)
    return m[:, k], m[:, :k]


def fit(data: DataFrame, features: list[str], label: str, weight: str, store: Callable[[DataFrame], DataFrame], max_steps: int = MAX_STEPS) -> tuple[float, list[float], int]:
    """Intercept, weights (of the features as they are), steps taken. ``store``
    writes the standardised rows to shared storage, so that no step goes back to
    what they were made from."""
    total, means, sds = moments(data, features, weight)
    rows = store(design(data, features, label, weight, means, sds))
    ridge = np.diag([0.0] + [RIDGE * total] * len(features))
    beta, steps = np.zeros(len(features) + 1), 0
    while steps < max_steps:
        score, gram = sums(rows, beta)
        score = score - ridge @ beta
        if np.abs(score).max() <= TOLERANCE * total:
            break
        beta, steps = beta + np.linalg.solve(gram + ridge, score), steps + 1
    weights = [float(b) / s if s > 0 else 0.0 for b, s in zip(beta[1:], sds)]
    return float(beta[0]) - sum(w * m for w, m in zip(weights, means)), weights, steps
