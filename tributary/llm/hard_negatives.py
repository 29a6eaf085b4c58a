"""Hard-negative mining with rotated one-bit codes.

Every vector x of integers is turned by ``turns`` random rotations; the signs
are its code b, one bit a dimension and rotation. Turned back and summed, the
signs give a code vector c. Stored with the code are the alignment t = <x, c> /
<c, c>, the squared length of c, and the length r of the residual x - t c, which
is orthogonal to c. For an anchor q therefore, by Cauchy-Schwarz,

    | <x, q> - t <c, q> |  <=  r * sqrt(|q|^2 - <c, q>^2 / |c|^2),

and <c, q> is the sum of the rotated anchor's components with the signs b: the
anchor's components are rounded to 8 bits and cut into bit planes, so that the
sum is a matter of popcounts; the absolute rounding errors, summed, widen the
interval. The bounds hold for every pair; nothing is left to chance.

Anchors meet all rows in tiles of a block of rows and a block of anchors. In a
tile the intervals say which rows can still be among the first; those alone are
scored, in integers. A tile returns at most ``positives`` (``negatives``) rows
for an anchor (and positive), and these are merged.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import again, written

SEED = 20_240_611
PLANES = 8
CODED = "x binary, dim int, code binary, align double, length2 double, residual double"
PAIR = pa.schema([("anchor", pa.int64()), ("bound", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
PAIR_DDL = "anchor long, bound long, row long, vec_id long, score long"


@lru_cache(maxsize=4)
def rotations(dim: int, turns: int) -> np.ndarray:
    """``turns`` orthogonal matrices below one another; the same in every task."""
    rng = np.random.default_rng(SEED + dim)
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(turns)])


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans packed into 64-bit words."""
    n, m = bits.shape
    padded = np.zeros((n, -(-m // 64) * 64), bool)
    padded[:, :m] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def encode(x: np.ndarray, turns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Integer vectors -> codes, alignments, squared lengths of the code vectors, residuals."""
    turn, v = rotations(x.shape[1], turns), x.astype(np.float64)
    bits = v @ turn.T >= 0
    c = np.where(bits, 1.0, -1.0) @ turn
    length2 = np.maximum(np.einsum("ij,ij->i", c, c), 1e-300)
    align = np.einsum("ij,ij->i", v, c) / length2
    return _words(bits), align, length2, np.linalg.norm(v - align[:, None] * c, axis=1)


class Anchor:
    """An anchor's bit planes and what bounds need to know of it."""

    def __init__(self, q: np.ndarray, turns: int):
        self.q, v = q, q.astype(np.float64)
        turned = rotations(len(q), turns) @ v
        self.low = float(turned.min())
        self.step = max((float(turned.max()) - self.low) / (2 ** PLANES - 1), 1e-300)
        level = np.clip(np.rint((turned - self.low) / self.step), 0, 2 ** PLANES - 1)
        self.error = float(np.abs(turned - self.low - self.step * level).sum())
        self.planes = _words(level.astype(np.int64)[None, :] >> np.arange(PLANES)[:, None] & 1 > 0)
        self.level, self.size, self.norm2 = float(level.sum()), len(turned), float(v @ v)

    def interval(self, rows: Rows, at: slice | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the products with the rows ``at``."""
        code = rows.code[:, at]
        met = np.zeros(code.shape[1], np.int64)  # sum of levels where the bit is set
        for j in range(PLANES):
            count = np.zeros(code.shape[1], np.int64)
            for w in range(len(code)):
                count += np.bitwise_count(code[w] & self.planes[j, w])
            met += count << j
        # sum of sign * (low + step * level), sign = 2 * bit - 1
        g = self.low * (2.0 * rows.ones[at] - self.size) + self.step * (2.0 * met - self.level)
        least = np.maximum(0.0, np.abs(g) - self.error)
        slack = 1e-9 * (1 + rows.norm[at] * np.sqrt(self.norm2))
        wide = rows.residual[at] * np.sqrt(np.maximum(0.0, self.norm2 - least * least / rows.length2[at])) + np.abs(rows.align[at]) * self.error + slack
        middle = rows.align[at] * g
        return middle - wide, middle + wide


class Rows:
    """The rows of a tile, grouped by label; codes word by word."""

    def __init__(self, table: pa.Table, labels: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.labels, table = labels[order], table.take(pa.array(order))
        self.row, self.vec_id = (np.array(table.column(c).to_numpy(), np.int64) for c in ("row", "vec_id"))
        self.x = _stack(table.column("x"), np.int32)
        self.code = np.ascontiguousarray(_stack(table.column("code"), np.uint64).T)
        self.ones = np.bitwise_count(self.code).sum(axis=0).astype(np.float64)
        self.align, self.length2, self.residual = (table.column(c).to_numpy() for c in ("align", "length2", "residual"))
        self.norm = np.linalg.norm(self.x.astype(np.float64), axis=1)

    def label(self, label: int) -> tuple[int, int]:
        lo, hi = np.searchsorted(self.labels, [label, label + 1])
        return int(lo), int(hi)

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        return self.x[at].astype(np.int64) @ q.astype(np.int64)

    def first(self, at: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` first by (score down, id up)."""
        return np.lexsort((self.vec_id[at], -score))[:most]


def _stack(column: pa.ChunkedArray, dtype) -> np.ndarray:
    values = [np.frombuffer(x.as_buffer(), dtype) for c in column.chunks for x in c]
    return np.stack(values)


def _threshold(low: np.ndarray, most: int) -> float:
    """What ``most`` rows reach for certain, or nothing."""
    return float(np.partition(low, len(low) - most)[len(low) - most]) if len(low) >= most else -np.inf


def _tile(left: pa.Table, right: pa.Table):
    """Rows and anchors of a tile, with labels as common numbers, or None."""
    if not left.num_rows or not right.num_rows:
        return None
    labels = pa.chunked_array(left.column("label").chunks + right.column("label").chunks).combine_chunks().dictionary_encode().indices.to_numpy()
    return Rows(left, labels[:left.num_rows]), labels[left.num_rows:], _stack(right.column("x"), np.int32), right.column("row").to_pylist()


def _coded(vectors: DataFrame, scale: float, turns: int) -> DataFrame:
    """Usable rows as integer vectors with their codes: row, vec_id, label, x, dim, code, align, length2, residual."""
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")).filter(sound)
    rows = rows.filter(F.size("embedding") > 0).withColumn("row", F.monotonically_increasing_id())
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for start in range(0, b.num_rows, 2048):
                part = b.slice(start, 2048)
                lists = part.column("embedding")
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                begin = np.cumsum(sizes) - sizes
                for dim in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == dim)
                    v = np.floor(scale * flat[begin[own][:, None] + np.arange(dim)])
                    with np.errstate(over="ignore"):
                        fits = (v * v).sum(axis=1) < 2.0 ** 62
                    own, x = own[fits], v[fits].astype(np.int32)
                    if not len(own):
                        continue
                    code, align, length2, residual = encode(x, turns)
                    t = part.select(["row", "vec_id", "label"]).take(pa.array(own))
                    yield pa.RecordBatch.from_arrays(
                        [*t.columns, pa.array([r.tobytes() for r in x], pa.binary()), pa.array(np.full(len(own), dim, np.int32)),
                         pa.array([r.tobytes() for r in code], pa.binary()), pa.array(align), pa.array(length2), pa.array(residual)],
                        ["row", "vec_id", "label", "x", "dim", "code", "align", "length2", "residual"])

    return rows.select("row", "vec_id", "label", "embedding").mapInArrow(run, f"row long, vec_id long, label {kind}, {CODED}")


def _spread(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """Each row in one block of its side, copied for every block of the other side."""
    return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _merged(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` first of what the tiles found for each anchor and bound, ranked."""
    order = Window.partitionBy("anchor", "bound").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, scale: float = 256, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   turns: int = 8, rows_per_tile: int | None = None, anchors_per_tile: int | None = None) -> DataFrame:
    """vectors (vec_id, label, embedding) -> anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    Scores are products of floor(scale * component). Anchors are the rows whose
    id is divisible by ``every``; an anchor's positives its first other rows of
    its label, by score down and id up. For each positive of score p the first
    rows of other labels with low * p <= 100 * score <= high * p follow; a
    positive below zero has none. Repeated rows and ids are rows of their own,
    so a repeated anchor row gives its rows again. Rows with a null label, id or
    vector, an empty vector or any null or non-finite component take no part,
    nor do integer vectors whose squared length is 2^62 or more (their products
    fit no long). Vectors of different lengths do not meet. Extra columns are
    not read; an empty table gives an empty result.

    Work grows with anchors times rows, at a few popcounts a pair; a row is
    copied once for each block of anchors (up to 65,536), an anchor once for
    each block of rows (up to 262,144), whatever label or value is frequent.
    """
    rows = written(_coded(vectors, scale, turns), "negatives-codes")
    n = rows.count()
    anchors = again(rows).filter(F.col("vec_id") % every == 0).select("row", "vec_id", "label", "x", "dim")
    row_blocks = max(1, -(-n // (rows_per_tile or min(1 << 18, max(2048, n // 64)))))
    anchor_blocks = max(1, -(-anchors.count() // (anchors_per_tile or 1 << 16)))
    key = ["dim", "block", "group"]
    by_rows = _spread(rows, "block", row_blocks, "group", anchor_blocks).groupBy(*key)

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        """Tiles' first rows of the anchor's label."""
        tile, out = _tile(left, right), []
        if tile:
            own, labels, xs, ids = tile
            for label, q, row in zip(labels.tolist(), xs, ids, strict=True):
                lo, hi = own.label(label)
                at = np.arange(lo, hi)[own.row[lo:hi] != row]
                if not len(at):
                    continue
                least, most = Anchor(q, turns).interval(own, at)
                at = at[most >= _threshold(least, positives)]
                score = own.scores(at, q)
                for i in own.first(at, score, positives).tolist():
                    out.append((row, 0, int(own.row[at[i]]), int(own.vec_id[at[i]]), int(score[i])))
        return _table(out)

    def within(left: pa.Table, right: pa.Table) -> pa.Table:
        """Tiles' first rows of other labels inside the band below each positive's score."""
        tile, out = _tile(left, right), []
        if tile:
            own, labels, xs, ids = tile
            for label, q, row, bounds in zip(labels.tolist(), xs, ids, right.column("bounds").to_pylist(), strict=True):
                lo, hi = own.label(label)
                at = np.r_[0:lo, hi:len(own.row)]
                if not len(at):
                    continue
                least, most = Anchor(q, turns).interval(own, at)
                wanted, bands = np.zeros(len(at), bool), [(p, low * p / 100, high * p / 100) for p in bounds]
                for _, a, b in bands:
                    sure = least[(least >= a) & (most <= b)]
                    wanted |= (most >= max(a, _threshold(sure, negatives))) & (least <= b)
                at = at[wanted]
                score = own.scores(at, q)
                for p, _, _ in bands:
                    floor, ceiling = -(-low * p // 100), high * p // 100
                    inside = (score >= floor) & (score <= ceiling)
                    some, s = at[inside], score[inside]
                    for i in own.first(some, s, negatives).tolist():
                        out.append((row, p, int(own.row[some[i]]), int(own.vec_id[some[i]]), int(s[i])))
        return _table(out)

    def tiles(asked: DataFrame, f) -> DataFrame:
        return by_rows.cogroup(_spread(asked, "group", anchor_blocks, "block", row_blocks).groupBy(*key)).applyInArrow(f, PAIR_DDL)

    near = written(_merged(tiles(anchors, nearest), positives), "negatives-positives")
    bounds = near.filter("score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_set("score")).alias("bounds"))
    far = _merged(tiles(anchors.join(bounds, "row"), within), negatives)
    far = far.select("anchor", F.col("bound").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(near, ["anchor", "positive_score"]).join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _table(out: list[tuple]) -> pa.Table:
    cols = list(zip(*out, strict=True)) if out else [[] for _ in PAIR]
    return pa.table([pa.array(c, pa.int64()) for c in cols], schema=PAIR)
