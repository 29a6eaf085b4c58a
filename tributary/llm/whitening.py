"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the eigenvalues and eigenvectors of the scatter of the
vectors it has seen. A vector (with the number of its copies in the batch)
moves the mean and adds a centred rank-one term; the new eigenvalues are the
roots of the secular equation, found between the old ones, after deflation of
components that the term does not touch and of equal eigenvalues. Spectra of
partitions are combined in a tree: one becomes a series of rank-one terms of
the other, and one more term carries the distance of their means.

The basis that comes out is refined once over all rows: the covariance is
projected on it (Rayleigh-Ritz) from exactly centred integers, n * x - S, summed
by partition and then in a tree, and the small projected problem is solved.
What travels is of the size of the dimension squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import drop_written, written

EPS = np.finfo(np.float64).eps
FAN = 16
REORTHOGONALISE = 512
SPECTRUM_DDL = "id long, n long, sums binary, mean binary, values binary, vectors binary"
SPECTRUM = pa.schema([("id", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("sums", "mean", "values", "vectors"))])
GRAM_DDL = "id long, gram binary"
GRAM = pa.schema([("id", pa.int64()), ("gram", pa.binary())])
OUT_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
                 ("explained", pa.float64()), ("identity_error", pa.float64())])


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2_i / (d_i - x) = 0 for rising d and z2 > 0: the matrix
    d_i - root_j and the roots. Each root is sought as its distance from the
    nearer pole, by rational interpolation kept inside a bracket."""
    k = len(d)
    last = d[-1] + z2.sum()
    right = np.append(d[1:], last)
    middle = (d + right) / 2
    above = 1 + (z2[:, None] / (d[:, None] - middle[None, :])).sum(axis=0) < 0  # the root is nearer to the right end
    above[-1] = False
    origin = np.where(above, right, d)
    delta = d[:, None] - origin[None, :]
    half = (right - d) / 2
    low, high = np.where(above, -half, 0.0), np.where(above, 0.0, half)
    high[-1] = last - d[-1]
    t = (low + high) / 2
    left = (np.arange(k)[:, None] <= np.arange(k)[None, :]).astype(np.float64)
    d1, d2 = d - origin, right - origin
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(60):
            gap = delta - t
            term = z2[:, None] / gap
            slope = term / gap
            psi, psi1 = np.einsum("ij,ij->j", term, left), np.einsum("ij,ij->j", slope, left)
            phi, phi1 = term.sum(axis=0) - psi, slope.sum(axis=0) - psi1
            f = 1 + psi + phi
            low, high = np.where(f < 0, t, low), np.where(f > 0, t, high)
            # what rounding leaves in f: of its sum, and of t itself
            done = np.abs(f) <= 8 * EPS * (1 + np.abs(psi) + np.abs(phi)) + 2 * EPS * np.abs(t) * (psi1 + phi1)
            if done.all():
                break
            g1, g2 = d1 - t, d2 - t
            c = 1 + (psi - g1 * psi1) + (phi - g2 * phi1)
            c[-1] = 1 + psi[-1] - g1[-1] * psi1[-1]
            a = c * (g1 + g2) + g1 * g1 * psi1 + g2 * g2 * phi1
            b = g1 * g2 * f
            root = np.sqrt(np.maximum(0.0, a * a - 4 * b * c))
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            move[-1] = g1[-1] + g1[-1] ** 2 * psi1[-1] / c[-1]
            new = np.where(done, t, t + move)
            bad = ~(done | ((new > low) & (new < high)))
            new[bad] = (low[bad] + high[bad]) / 2
            if (new == t).all():
                break
            t = new
    return delta - t[None, :], origin + t


def add_rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) after adding u u'."""
    z = vectors.T @ u
    size = float(z @ z)
    scale = max(float(values[-1]), size)
    if size <= EPS * scale or scale == 0:
        return values, vectors
    # deflation: a run of equal eigenvalues is turned so that one of its vectors takes the whole of z
    equal = np.diff(values) <= 8 * EPS * scale
    if equal.any():
        vectors = vectors.copy()
        edge = np.flatnonzero(np.diff(np.r_[False, equal, False].astype(np.int8)))
        for lo, hi in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist(), strict=True):
            part = z[lo:hi].copy()
            norm = float(np.sqrt(part @ part))
            if norm == 0:
                continue
            h = part.copy()
            h[-1] += np.copysign(norm, part[-1])
            vectors[:, lo:hi] -= np.outer(vectors[:, lo:hi] @ h, 2 / (h @ h) * h)
            z[lo:hi] = 0
            z[hi - 1] = -np.copysign(norm, part[-1])
    live = np.abs(z) * np.sqrt(size) > 8 * EPS * scale
    if not live.any():
        return values, vectors
    d, w = values[live], z[live]
    gaps, roots = secular_roots(d, w * w)
    # the z whose secular equation has exactly these roots keeps the vectors orthogonal
    k = len(d)
    over = d[None, :] - d[:, None]
    shifted = np.concatenate([over[:, 1:], np.ones((k, 1))], axis=1)
    below = np.tril(np.ones((k, k), bool), -1)
    w = np.copysign(np.sqrt(np.abs(gaps / np.where(below, over, shifted)).prod(axis=1)), w)
    turn = w[:, None] / gaps
    turn /= np.linalg.norm(turn, axis=0)
    values, out = values.copy(), vectors.copy()
    values[live], out[:, live] = roots, vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], out[:, order]


class Spectrum:
    """Count, exact sums, mean, and the eigendecomposition of the scatter about the mean."""

    def __init__(self, n: int, sums: np.ndarray, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.mean, self.values, self.vectors, self.steps = n, sums, mean, values, vectors, 0

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim, np.int64), np.zeros(dim), np.zeros(dim), np.eye(dim))

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        mean = np.frombuffer(row["mean"])
        return cls(row["n"], np.frombuffer(row["sums"], np.int64), mean, np.frombuffer(row["values"]), np.frombuffer(row["vectors"]).reshape(len(mean), -1))

    def row(self, number: int) -> dict:
        return {"id": number, "n": self.n, "sums": self.sums.tobytes(), "mean": self.mean.tobytes(), "values": self.values.tobytes(),
                "vectors": np.ascontiguousarray(self.vectors).tobytes()}

    def term(self, u: np.ndarray) -> None:
        self.values, self.vectors = add_rank_one(self.values, self.vectors, u)
        self.steps += 1
        if self.steps % REORTHOGONALISE == 0:
            self.vectors = np.linalg.qr(self.vectors)[0]

    def add(self, x: np.ndarray, times: int) -> None:
        """``times`` copies of the integer vector x."""
        far, n = x - self.mean, self.n + times
        if self.n:
            self.term(far * np.sqrt(self.n * times / n))
            self.mean = self.mean + far * (times / n)
        else:
            self.mean = x.astype(np.float64)
        self.sums, self.n = self.sums + x * times, n

    def merge(self, other: Spectrum) -> None:
        """Another spectrum's scatter as rank-one terms, and one for the means."""
        if not other.n:
            return
        n, far = self.n + other.n, other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.term(np.sqrt(value) * vector)
        if self.n:
            self.term(far * np.sqrt(self.n * other.n / n))
        self.mean = self.mean + far * (other.n / n)
        self.sums, self.n = self.sums + other.sums, n


def _batches(batches: Iterator[pa.RecordBatch], scale: float, offset: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices with their vectors as integers."""
    for b in batches:
        for start in range(0, b.num_rows, 4096):
            part = b.slice(start, 4096)
            lists = part.column("embedding")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield part, np.floor(scale * x).astype(np.int64) + offset


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exactly: as longs where they fit, else as Python integers."""
    if n * int(np.abs(x).max(initial=0)) < 2 ** 62:
        return n * x - sums
    return n * x.astype(object) - sums.astype(object)


def deviations(far: np.ndarray) -> list[int | None]:
    """Sums of squares by row, exactly; None beyond a long."""
    if far.dtype != object and int(np.abs(far).max(initial=0)) ** 2 * far.shape[1] < 2 ** 63:
        return (far * far).sum(axis=1).tolist()
    squares = [sum(int(v) ** 2 for v in r) for r in far]
    return [v if v < 2 ** 63 else None for v in squares]


def _tree(df: DataFrame, merge: Callable[[list[dict]], dict], ddl: str, schema: pa.Schema, name: str) -> dict | None:
    """Rows (id, ...) merged ``FAN`` at a time, in the order of their ids, until one is left."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(schema.names).to_pylist(), key=lambda r: r["id"])
        return pa.Table.from_pylist([merge(rows) | {"id": rows[0]["id"] // FAN}], schema)

    state = written(df, name)
    numbers = sorted(r[0] for r in state.select("id").collect())  # one number for each partition
    while len(numbers) > 1:
        new = written(state.groupBy(F.floor(F.col("id") / FAN).alias("at")).applyInArrow(run, ddl), name)
        drop_written(state)
        state, numbers = new, sorted({i // FAN for i in numbers})
    row = state.first()
    drop_written(state)
    return row.asDict() if row else None


def _gram(df: DataFrame, scale: float, offset: int, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum over all rows of the outer products of (x - S / n) projected on the basis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((basis.shape[1],) * 2)
        for _, x in _batches(batches, scale, offset):
            y = centred(x, n, sums).astype(np.float64) / n @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pylist([{"id": TaskContext.get().partitionId(), "gram": total.tobytes()}], GRAM)

    def merge(rows: list[dict]) -> dict:
        return {"gram": sum(np.frombuffer(r["gram"]) for r in rows).tobytes()}

    row = _tree(df.select("embedding").mapInArrow(run, GRAM_DDL), merge, GRAM_DDL, GRAM, "whitening-gram")
    return np.frombuffer(row["gram"]).reshape(basis.shape[1], -1)


def whiten(vectors: DataFrame, components: int = 32, scale: float = 64, offset: int = 1_000_000) -> DataFrame:
    """vectors (vec_id, embedding) -> vec_id, component, n, deviation, whitened,
    explained, identity_error; a row for each usable vector and each of the
    first ``components`` components (all, if there are fewer).

    An entry c becomes x = floor(scale * c) + offset. Components are unit
    eigenvectors of the covariance of x (divisor n), by falling eigenvalue, the
    largest entry of each positive. ``deviation`` is the sum of (n * x - S)^2,
    null if it fits no long. ``identity_error`` is measured over all rows.

    Vectors that are null or empty or hold null or non-finite entries, or
    entries of 2^31 / scale or more, take no part; nor do those whose length is
    not the most frequent one (of equals the larger). Null and repeated ids
    are carried along: every row counts. A component without variance (one row,
    a constant dimension, fewer rows than dimensions) cannot be whitened: its
    ``whitened`` is null, and ``identity_error`` is that of the others (null if
    there are none); ``explained`` is null where nothing varies. Extra columns
    are not read; an empty table gives an empty result.

    The dimension squared bounds what a task holds and what reaches the driver.
    """
    entry = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= 2.0 ** 31 / scale)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter("size(embedding) > 0").filter(~F.exists("embedding", entry))
    size = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], OUT_DDL)
    dim = size["dim"]
    rows = rows.filter(F.size("embedding") == dim)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = Spectrum.empty(dim)
        for _, x in _batches(batches, scale, offset):
            one, times = np.unique(x, axis=0, return_counts=True)
            for v, t in zip(one, times.tolist(), strict=True):
                own.add(v, t)
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row(TaskContext.get().partitionId())], SPECTRUM)

    def merge(spectra: list[dict]) -> dict:
        whole = Spectrum.empty(dim)
        for s in spectra:
            if whole.n:
                whole.merge(Spectrum.of(s))
            else:
                whole = Spectrum.of(s)
        return whole.row(0)

    whole = Spectrum.of(_tree(rows.select("embedding").mapInArrow(fit, SPECTRUM_DDL), merge, SPECTRUM_DDL, SPECTRUM, "whitening-spectra"))
    n, sums, basis = whole.n, whole.sums.copy(), np.linalg.qr(whole.vectors)[0]
    values, turn = np.linalg.eigh(_gram(rows, scale, offset, n, sums, basis) / n)
    values, axes = np.maximum(values[::-1], 0.0), basis @ turn[:, ::-1]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(dim)])
    many, trace = min(components, dim), float(values.sum())
    live = values[:many] > 4 * dim * EPS * values[0]
    axes = np.where(live, axes[:, :many] / np.sqrt(np.where(live, values[:many], 1.0)), 0.0)
    error = None
    if live.any():
        error = float(np.abs(_gram(rows, scale, offset, n, sums, axes[:, live]) / n - np.eye(int(live.sum()))).max())
    explained = [float(v) / trace if trace > 0 else None for v in values[:many]]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _batches(batches, scale, offset):
            far, m = centred(x, n, sums), part.num_rows
            w = far.astype(np.float64) / n @ axes
            each = np.repeat(np.arange(m), many)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), m)), pa.array(np.full(m * many, n)),
                 pa.array(deviations(far), pa.int64()).take(pa.array(each)), pa.array(w.ravel(), mask=np.tile(~live, m)),
                 pa.array(explained * m, pa.float64()), pa.array([error] * (m * many), pa.float64())], schema=OUT)

    return rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(project, OUT_DDL)
