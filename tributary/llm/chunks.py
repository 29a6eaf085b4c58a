"""Documents packed into chunks, and packed exchanges between chunks and hash buckets.

A chunk row holds the bytes of some documents. A step maps each chunk to keys
(hashes), sorted, and deals them to buckets of the hash space, many keys to a
row; a bucket answers each chunk with one byte per key. Positions never
travel: a chunk finds them again by computing its keys anew. The chunk table
is bucketed by chunk, so joining the answers does not shuffle the texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import remember, shared_dir

CHUNKS_A_TASK = 64
ONE = np.uint64(1)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i up to n at least."""
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n + 1, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if n > 1 << 20:
            return made[0], made[1]  # of a huge text: not kept
        _POWERS[base] = made[0], made[1]
    return _POWERS[base]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Sums of values[j] * base ** j over j < i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[0][:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end], the same wherever it stands."""
    return (sums[end] - sums[start]) * powers(base, len(sums))[1][start]


def pack(docs: DataFrame, separator: bytes, chunk_bytes: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text) -> a written table (chunk, doc_ids, sizes, n_bytes,
    content), bucketed by chunk. Chunks follow the input's own partitions; a
    text larger than ``chunk_bytes`` is a chunk of its own. A null text is
    empty. Columns named in ``carry`` come along as a list of structs. The table
    has a bucket for each ``CHUNKS_A_TASK`` chunks, so that a task's share does
    not grow with the input."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.select("doc_id", "text", *([F.struct(*carry).alias("carried")] if carry else []))
    kind = docs.schema["carried"].dataType if carry else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, parts, more, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        names = ["chunk", "doc_ids", "sizes", "n_bytes", "content", "carried"][:6 if carry else 5]

        def row() -> pa.RecordBatch:
            content = separator.join(parts)
            cols = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                    pa.array([len(content)]), pa.array([content], pa.binary())]
            return pa.RecordBatch.from_arrays(cols + ([pa.array([more], pa.list_(more_type))] if carry else []), names)

        more_type = None
        for b in batches:
            more_type = b.schema.field(2).type if carry else None
            for at in range(0, b.num_rows, 1024):
                s = b.slice(at, 1024)
                rest = s.column(2).to_pylist() if carry else [None] * s.num_rows
                for i, t, x in zip(s.column(0).to_pylist(), s.column(1).to_pylist(), rest, strict=True):
                    t = (t or "").encode()
                    if parts and size + len(t) > chunk_bytes:
                        yield row()
                        number, ids, parts, more, size = number + 1, [], [], [], 0
                    ids.append(i)
                    parts.append(t)
                    more.append(x)
                    size += len(t) + len(separator)
        if parts:
            yield row()

    made = docs.mapInArrow(run, "chunk long, doc_ids array<long>, sizes array<long>, n_bytes long, content binary"
                           + (f", carried array<{kind.simpleString()}>" if carry else ""))
    name = f"llm_chunks_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (CHUNKS_A_TASK * chunk_bytes)))
    path = f"{shared_dir(spark)}/{name}"
    remember(spark, path, name)
    made.write.option("path", path).option("compression", "zstd").bucketBy(min(100_000, buckets), "chunk").saveAsTable(name, format="parquet")
    return spark.table(name)


def bucket_count(chunks: DataFrame, bucket_bytes: int) -> int:
    """Buckets in proportion to the text, so that each is of bounded size; 64 at least."""
    n = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(64, min(1 << 24, -(-n // bucket_bytes)))


def bucket_bounds(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys; a bucket is a range of the hash space."""
    b = ((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    edge = np.r_[np.flatnonzero(np.r_[True, b[1:] != b[:-1]]), len(b)] if len(b) else np.zeros(1, np.int64)
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(b[lo]), lo, hi


def with_answers(chunks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Chunks with a list of (bucket, flags) for each answer table (bucket, chunk, flags), or null."""
    for name, df in answers.items():
        per = df.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "flags")).alias(name)).hint("shuffle_hash")
        chunks = chunks.join(per, "chunk", "left")
    return chunks


def placed(keys: np.ndarray, buckets: int, answer: list[dict] | None) -> np.ndarray:
    """One byte for each of the sorted keys, 0 where nothing was answered."""
    out = np.zeros(len(keys), np.uint8)
    if answer:
        got = {a["bucket"]: a["flags"] for a in answer}
        for b, lo, hi in bucket_bounds(keys, buckets):
            if b in got:
                out[lo:hi] = np.frombuffer(got[b], np.uint8)
    return out


def map_chunks(chunks: DataFrame, f: Callable[[dict], Iterator[dict]], ddl: str, schema: pa.Schema) -> DataFrame:
    """f on each chunk row (content as a byte array); the rows it yields, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                d = {n: row.column(n)[0].as_py() for n in row.schema.names if n != "content"}
                d["content"] = np.frombuffer(row.column("content")[0].as_buffer(), np.uint8) if row.column("content")[0].as_buffer().size else np.zeros(0, np.uint8)
                rows, held = [], 0
                for out in f(d):
                    rows.append(out)
                    held += 1
                    if held == 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return chunks.mapInArrow(run, ddl)


def by_bucket(dealt: DataFrame, f: Callable[[dict], list[np.ndarray]], inputs: list[str]) -> DataFrame:
    """Answers (bucket, chunk, flags): f sees a bucket's rows (lists of buffers
    by column) and gives the flags of each; rows without a flag set are left out."""

    def run(table: pa.Table) -> pa.Table:
        cols = {c: [x.as_buffer() for chunk in table.column(c).chunks for x in chunk] for c in inputs}
        flags = f(cols)
        keep = [i for i, x in enumerate(flags) if x.any()]
        got = table.select(["bucket", "chunk"]).take(pa.array(keep, pa.int64()))
        return got.append_column("flags", pa.array([flags[i].tobytes() for i in keep], pa.binary()))

    return dealt.select("bucket", "chunk", *inputs).groupBy("bucket").applyInArrow(run, "bucket long, chunk long, flags binary")


KEYS_DDL = "bucket long, chunk long, first binary, second binary, own binary"
KEYS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("own", pa.binary())])


def repeated_keys(cols: dict) -> list[np.ndarray]:
    """For ``by_bucket``: 1 for each 96-bit key (first, second) that two chunks
    have, or one chunk more than once (own)."""
    first = [np.frombuffer(x, np.uint64) for x in cols["first"]]
    size = np.array([len(x) for x in first])
    k1, k2 = np.concatenate(first), np.concatenate([np.frombuffer(x, np.uint32) for x in cols["second"]])
    own = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["own"]])
    order = np.lexsort((k2, k1))
    same = (k1[order][1:] == k1[order][:-1]) & (k2[order][1:] == k2[order][:-1])
    group = np.r_[0, np.cumsum(~same)] if len(order) else order
    hit = (np.bincount(group, own[order]) > 0) | (np.bincount(group) > 1)
    out = np.zeros(len(order), np.uint8)
    out[order] = hit[group]
    return np.split(out, np.cumsum(size)[:-1])
