"""Language ID with string kernels.

The blended-spectrum presence kernel of two texts counts the distinct byte
n-grams (n = 1 .. ``orders``, lower case) that they share, over the geometric
mean of their own counts. A Nystroem map onto landmark texts makes one-versus-
rest kernel ridge regression linear, and documents are scored in batches by
two matrix products: presence by landmarks, then landmarks by languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import rows_to_batch

LETTER = regex.compile(r"\p{L}")  # as training asks of Spark's rlike
UNKNOWN = "und"
DDL = "doc_id long, held_out boolean, lang_pred string, score double"
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


class Grams:
    """Distinct n-gram codes of a text. Codes of different n do not meet."""

    def __init__(self, orders: int = 3):
        self.orders = orders
        self.bases = np.cumsum([0] + [256 ** n for n in range(1, orders + 1)])
        self.last = np.zeros(int(self.bases[-1]), np.int32)  # scratch: the last place of each code

    def distinct(self, text: str) -> np.ndarray:
        b = np.frombuffer(text.lower().encode(), np.uint8).astype(np.int32)
        out, code = [], b
        for n in range(1, self.orders + 1):
            if n > 1:
                code = code[:-1] * 256 + b[n - 1:]
            if not len(code):
                break
            at, place = code + np.int32(self.bases[n - 1]), np.arange(len(code), dtype=np.int32)
            self.last[at] = place
            out.append(at[self.last[at] == place])
        return np.concatenate(out) if out else np.zeros(0, np.int32)


@dataclass
class KernelModel:
    """languages; codes: the vocabulary, all gram codes of landmarks; presence: vocabulary x landmarks; own: the landmarks' gram counts;
    weights: landmarks and a constant x languages."""

    languages: list[str]
    codes: np.ndarray
    presence: np.ndarray
    own: np.ndarray
    weights: np.ndarray
    orders: int

    def kernel(self, grams: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(grams), len(self.codes)), np.float32)
        for i, g in enumerate(grams):
            r = rows[g]
            x[i, r[r > 0] - 1] = 1
        size = np.maximum(1, np.array([len(g) for g in grams], np.float64))
        return (x @ self.presence) / np.sqrt(size[:, None] * self.own[None, :])

    def rows(self) -> np.ndarray:
        """By gram code: its row of ``presence`` plus one, 0 for none (most
        pages of the table are then never touched)."""
        at = np.zeros(int(np.cumsum([256 ** n for n in range(1, self.orders + 1)])[-1]), np.int32)
        at[self.codes] = np.arange(1, len(self.codes) + 1, dtype=np.int32)
        return at

    def score(self, grams: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        k = self.kernel(grams, rows)
        return np.c_[k, np.ones(len(k))] @ self.weights


def fit(texts: list[str], langs: list[str], landmarks: int = 48, orders: int = 3, ridge: float = 1e-2) -> KernelModel | None:
    """Ridge regression on the Nystroem features of at most ``landmarks`` texts
    of each language (the first given); None without texts."""
    if not texts:
        return None
    names, taken, seen = sorted(set(langs)), [], dict.fromkeys(langs, 0)
    for i, lang in enumerate(langs):
        seen[lang] += 1
        if seen[lang] <= landmarks:
            taken.append(i)
    maker = Grams(orders)
    grams = [maker.distinct(t) for t in texts]
    codes = np.unique(np.concatenate([grams[i] for i in taken]))
    model = KernelModel(names, codes, np.zeros((len(codes), len(taken)), np.float32), np.ones(len(taken)), np.zeros(0), orders)
    rows = model.rows()
    for j, i in enumerate(taken):
        model.presence[rows[grams[i]] - 1, j] = 1
        model.own[j] = len(grams[i])
    k = np.concatenate([model.kernel(grams[lo:lo + 128], rows) for lo in range(0, len(grams), 128)])
    value, vector = np.linalg.eigh(k[taken] + 1e-9 * np.eye(len(taken)))
    keep = value > 1e-6 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])  # K_mm to the power -1/2, on its range
    feature = np.c_[k @ root, np.ones(len(k))]
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    balance = 1 / np.array([langs.count(x) for x in langs])[:, None]
    w = np.linalg.solve(feature.T @ (balance * feature) + ridge * np.eye(feature.shape[1]) / len(k), feature.T @ (balance * y))
    model.weights = np.r_[root @ w[:-1], w[-1:]]
    return model


def training_sample(docs: DataFrame, train, per_language: int, max_chars: int) -> tuple[list[str], list[str]]:
    """At most about ``per_language`` labelled texts of each language, chosen by
    a hash of the id, none longer than ``max_chars``: the documented bound on
    what the fit reads. A language with fewer such texts is filled up with
    slices of ``max_chars`` from its longer ones, as many of each as needed."""
    labelled = docs.filter(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.filter(F.col("text").rlike(r"\p{L}"))
    brief = F.length("text") <= max_chars
    counts = {r[0]: (r[1], r[2]) for r in labelled.groupBy("lang").agg(F.count_if(brief), F.count_if(~brief)).collect()}
    if not counts:
        return [], []
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    texts, langs = [], []

    def take(rows: DataFrame, wanted: dict, there: dict) -> None:
        """``wanted`` texts of each language, by hash, out of rows of which there are ``there``."""
        rate = F.create_map(*[F.lit(v) for k, n in sorted(wanted.items()) for v in (k, min(1.0, 1.5 * n / there[k]))])
        some = rows.withColumn("u", u).filter(F.col("u") < rate[F.col("lang")]).withColumn("u", F.col("u") / rate[F.col("lang")])
        got = dict.fromkeys(wanted, 0)
        if "pieces" in rows.columns:
            some = some.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
            some = some.withColumn("text", F.substring("text", (F.col("at") * F.lit(max_chars) + 1).cast("int"), F.lit(max_chars))).filter(F.col("text").rlike(r"\p{L}"))
        else:
            some = some.withColumn("at", F.lit(0))
        for r in some.select("lang", "text", "u", "doc_id", "at").orderBy("at", "u", "doc_id", "text").limit(2 * sum(wanted.values())).collect():
            got[r["lang"]] += 1
            if got[r["lang"]] <= wanted[r["lang"]]:
                texts.append(r["text"])
                langs.append(r["lang"])

    short = {k: n for k, (n, _) in counts.items() if n}
    if short:
        take(labelled.filter(brief), dict.fromkeys(short, per_language), short)
    long = {k: n for k, (few, n) in counts.items() if n and few < per_language}
    if long:
        lack = {k: per_language - counts[k][0] for k in long}
        each = F.create_map(*[F.lit(v) for k, n in sorted(long.items()) for v in (k, -(-lack[k] // n))])
        rows = labelled.filter(~brief & F.col("lang").isin(list(long))).withColumn("text", F.regexp_replace("text", r"^\P{L}+", ""))
        take(rows.withColumn("pieces", F.least(each[F.col("lang")], F.ceil(F.length("text") / max_chars).cast("int"))), lack, long)
    return texts, langs


def language_id(docs: DataFrame, per_language: int = 200, max_chars: int = 20000, landmarks: int = 48, orders: int = 3,
                batch: int = 128, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, lang) -> doc_id, held_out, lang_pred, score, and
    ``carried`` (a struct of the columns named in ``carry``); one row for each row.

    Documents whose crc32(doc_id as text) mod 4 is 2 are held out, the others
    with a label may be learned from; a bounded sample of them is
    (``training_sample``). Predictions read the whole text and nothing else.
    A null text, one without a letter, or any text where no label could be
    learned gets ``und`` with score 0. Equal scores go to the first language
    in code point order. The score is the best margin mapped to 0 to 1. A null
    id is not held out and not learned from. Extra columns are not read; an
    empty table gives an empty result.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = fit(*training_sample(docs, ~held, per_language, max_chars), landmarks=landmarks, orders=orders)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        maker, rows = Grams(orders), m.rows() if m else None

        def slice_of(part: pa.RecordBatch) -> pa.RecordBatch:
            ids, texts, held_out = (part.column(i).to_pylist() for i in range(3))
            ok = [i for i, t in enumerate(texts) if m and t and LETTER.search(t)]
            lang, score = [UNKNOWN] * len(ids), [0.0] * len(ids)
            if ok:
                margins = m.score([maker.distinct(texts[i]) for i in ok], rows)
                best = margins.argmax(axis=1)
                for i, b, v in zip(ok, best.tolist(), margins.max(axis=1).tolist(), strict=True):
                    lang[i], score[i] = m.languages[b], min(1.0, max(0.0, (v + 1) / 2))
            out = rows_to_batch(list(zip(ids, held_out, lang, score, strict=True)), ARROW)
            return pa.RecordBatch.from_arrays([*out.columns, part.column(3)], [*out.schema.names, "carried"]) if carry else out

        for b in batches:
            for at in range(0, b.num_rows, batch):
                yield slice_of(b.slice(at, batch))

    some = docs.select("doc_id", "text", held.alias("held_out"), *([F.struct(*carry).alias("carried")] if carry else []))
    return some.mapInArrow(run, f"{DDL}, carried {some.schema['carried'].dataType.simpleString()}" if carry else DDL)
