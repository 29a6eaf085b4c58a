"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of ``block`` bytes, the last one padded
with zeros. All blocks of the corpus are sorted and named by integers, equal
blocks alike; then neighbouring names are paired and the pairs are named the
same way, until every document has one name. Names of a round differ whenever
what they stand for differs, so a document's name together with its length in
bytes (which fixes its number of blocks and rounds, and what is padding) is an
identity without collisions. No hash decides whether texts are equal; hashes
only say which bucket names a block.

Documents travel in chunks. A chunk sends each distinct block (pair) once,
many to a row, to the buckets of the hash space; a bucket sorts what it got
and answers with one name per block. A bucket is an interval of names, so
names depend on the blocks alone, not on the order in which rows arrive, and a
task that is run again gives the same ones. Copies, however many, cost a block
per chunk; the last exchange, of identities, works alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.chunks import bucket_bounds, mix
from tributary.llm.common import drop_written, written

PAIR = 16
#: Fixed value: stands beside the last name of an odd number; no name is as large.
NOTHING = np.uint64(2 ** 64 - 1)

FIRST_DDL = "kind int, bucket long, chunk long, keys binary, doc_ids array<long>, sizes binary, digests binary, at binary"
FIRST = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                   ("sizes", pa.binary()), ("digests", pa.binary()), ("at", pa.binary())])
DEALT_DDL = "bucket long, chunk long, keys binary"
DEALT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary())])
STATE_DDL = "open boolean, chunk long, docs binary, counts binary, names binary"
STATE = pa.schema([("open", pa.bool_()), ("chunk", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()), ("names", pa.binary())])
CLAIM_DDL = "bucket long, chunk long, keys binary, times binary, best binary, known binary"
CLAIM = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("times", pa.binary()), ("best", pa.binary()), ("known", pa.binary())])
GROUP_DDL = "bucket long, chunk long, times binary, best binary, known binary, here binary"
OUT_DDL = "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"
OUT = pa.schema([("doc_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("text_sha256", pa.string())])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of bytes, all of one width that is a multiple of 8 -> the distinct
    ones in the order of a hash, the hashes, and each row's place among them."""
    width = keys.shape[1]
    one, at = np.unique(np.ascontiguousarray(keys).view(f"S{width}").ravel(), return_inverse=True)
    words = one.view(np.uint64).reshape(len(one), width // 8)
    h = np.zeros(len(one), np.uint64)
    for j in range(width // 8):
        h = mix(h ^ words[:, j] ^ np.uint64(j + 1))
    order = np.argsort(h, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return one[order], h[order], place[at]


def pairs(counts: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of documents, ``counts`` of each, in pairs of neighbours (as rows of bytes), and the pairs of each."""
    half = (counts + 1) // 2
    out = np.full(2 * int(half.sum()), NOTHING)
    shift = 2 * (np.cumsum(half) - half) - (np.cumsum(counts) - counts)
    out[np.arange(len(names)) + np.repeat(shift, counts)] = names
    return out.astype(">u8").view(np.uint8).reshape(-1, PAIR), half


def _rows(df: DataFrame, f: Callable[[dict], Iterator[dict]], ddl: str, schema: pa.Schema) -> DataFrame:
    """The rows that f yields for each row; binary values come as buffers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: (c[i].as_buffer() if pa.types.is_binary(c.type) and c[i].is_valid else c[i].as_py()) for n, c in zip(batch.schema.names, batch.columns, strict=True)}
                out = list(f(row))
                for at in range(0, len(out), 4096):
                    yield pa.RecordBatch.from_pylist(out[at:at + 4096], schema)

    return df.mapInArrow(run, ddl)


def _first(docs: DataFrame, block: int, chunk_bytes: int, buckets: int) -> DataFrame:
    """Kind 0: a chunk's documents (ids, sizes, digests) and the place of each
    block among the chunk's distinct ones. Kind 1: these blocks, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(t) for t in texts], np.int64)
            padded = b"".join(t.ljust(max(1, -(-len(t) // block)) * block, b"\0") for t in texts)
            one, h, at = distinct(np.frombuffer(padded, np.uint8).reshape(-1, block))
            out = [{"kind": 0, "chunk": chunk, "doc_ids": ids, "sizes": sizes.tobytes(), "at": at.astype(np.int32).tobytes(),
                    "digests": b"".join(hashlib.sha256(t).digest() for t in texts)}]
            out += [{"kind": 1, "bucket": b, "chunk": chunk, "keys": one[lo:hi].tobytes()} for b, lo, hi in bucket_bounds(h, buckets)]
            for start in range(0, len(out), 4096):
                yield pa.RecordBatch.from_pylist(out[start:start + 4096], FIRST)

        for b in batches:
            for start in range(0, b.num_rows, 1024):
                part = b.slice(start, 1024)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    t = (t or "").encode().lower()  # of bytes: A-Z only
                    if texts and held + len(t) > chunk_bytes:
                        yield from rows()
                        chunk, ids, texts, held = chunk + 1, [], [], 0
                    ids.append(i)
                    texts.append(t)
                    held += max(len(t), block)
        if texts:
            yield from rows()

    return docs.select("doc_id", "text").mapInArrow(run, FIRST_DDL)


def _named(dealt: DataFrame, width: int) -> DataFrame:
    """Distinct keys sorted within their bucket, an interval of the names: (bucket, chunk, names)."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_buffer(), f"S{width}") for c in table.column("keys").chunks for x in c]
        _, rank = np.unique(np.concatenate(keys), return_inverse=True)
        rank = rank.astype(np.uint64) + (np.uint64(table.column("bucket")[0].as_py()) << np.uint64(40))
        cut = np.cumsum([len(k) for k in keys])[:-1]
        return table.select(["bucket", "chunk"]).append_column("names", pa.array([x.tobytes() for x in np.split(rank, cut)], pa.binary()))

    return dealt.select("bucket", "chunk", "keys").groupBy("bucket").applyInArrow(run, "bucket long, chunk long, names binary")


def _with(state: DataFrame, answers: DataFrame, *values: str) -> DataFrame:
    """State rows with the answers to their chunk, a list by bucket."""
    return state.join(answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", *values)).alias("got")), "chunk")


def _joined(got: list[dict], value: str, dtype) -> np.ndarray:
    """Answers in the order in which the keys were sent: buckets are intervals of the hash order."""
    return np.frombuffer(b"".join(x[value] for x in sorted(got, key=lambda x: x["bucket"])), dtype)


def _split(chunk: int, docs: np.ndarray, counts: np.ndarray, names: np.ndarray) -> Iterator[dict]:
    """State rows of the documents with several names, and of those with one."""
    for open_ in (True, False):
        own = (counts > 1) == open_
        if own.any():
            yield {"open": open_, "chunk": chunk, "docs": docs[own].astype(np.int32).tobytes(), "counts": counts[own].tobytes(),
                   "names": names[np.repeat(own, counts)].tobytes()}


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["counts"], np.int64), np.frombuffer(row["names"], np.uint64)


def _by_chunk(heads: DataFrame, ends: DataFrame) -> DataFrame:
    return heads.join(ends.groupBy("chunk").agg(F.collect_list(F.struct("docs", "names")).alias("ends")), "chunk")


def _identities(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (size, name) of a chunk's documents, as ``distinct`` gives them."""
    sizes = np.frombuffer(row["sizes"], np.int64)
    names = np.empty(len(sizes), np.uint64)
    for x in row["ends"]:
        names[np.frombuffer(x["docs"], np.int32)] = np.frombuffer(x["names"], np.uint64)
    return distinct(np.stack([sizes.astype(np.uint64), names], axis=1).astype(">u8").view(np.uint8).reshape(-1, PAIR))


def _best(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Identities (keys, hashes), how often each stands here, its largest id,
    whether there is one, and the place of the first row that has it."""
    one, h, at = _identities(row)
    known = np.array([i is not None for i in row["doc_ids"]], bool)
    ids = np.array([i or 0 for i in row["doc_ids"]], np.int64)
    order = np.lexsort((-np.arange(len(ids)), ids, known, at))
    last = order[np.r_[at[order][1:] != at[order][:-1], True]]  # of each identity, in its order
    return one, h, np.bincount(at), ids[last], known[last], last


def block_naming(docs: DataFrame, block: int = 256, chunk_bytes: int | None = None, bucket_bytes: int | None = None) -> DataFrame:
    """docs (doc_id, text) -> doc_id, keep_id, group_size, kept, text_sha256
    (of the normalised text), one row for each row.

    Texts are equal when they are so after lower-casing A-Z; a null text is
    empty. Of equal texts the row with the largest doc_id stays, a null id
    counting as the smallest; of rows that share that id the first one read. Ids
    may repeat. Extra columns are not read; an empty table gives an empty
    result.

    Rounds grow with the logarithm of the longest text; a round moves 8 bytes
    for each block that is left of documents not yet named, and is one written
    table. ``chunk_bytes`` and ``bucket_bytes`` default to shares of the input:
    2 to 64 MB and twice that. A text longer than a chunk is a chunk of its own.
    """
    if block % 8 or block < 8:
        raise ValueError("block must be a multiple of 8")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunk_bytes = chunk_bytes or min(64 << 20, max(2 << 20, total // 20_000))
    bucket_bytes = bucket_bytes or 2 * chunk_bytes
    buckets = max(16, min(1 << 23, -(-total // bucket_bytes)))

    def step(row: dict) -> Iterator[dict]:
        keys, half = pairs(*_unpacked(row))
        yield from _split(row["chunk"], np.frombuffer(row["docs"], np.int32), half, _joined(row["got"], "names", np.uint64)[distinct(keys)[2]])

    def deal(row: dict) -> Iterator[dict]:
        one, h, _ = distinct(pairs(*_unpacked(row))[0])
        for b, lo, hi in bucket_bounds(h, buckets):
            yield {"bucket": b, "chunk": row["chunk"], "keys": one[lo:hi].tobytes()}

    def start(row: dict) -> Iterator[dict]:
        sizes = np.frombuffer(row["sizes"], np.int64)
        names = _joined(row["got"], "names", np.uint64)[np.frombuffer(row["at"], np.int32)]
        yield from _split(row["chunk"], np.arange(len(sizes)), np.maximum(1, -(-sizes // block)), names)

    def claim(row: dict) -> Iterator[dict]:
        one, h, times, best, known, _ = _best(row)
        for b, lo, hi in bucket_bounds(h, buckets):
            yield {"bucket": b, "chunk": row["chunk"], "keys": one[lo:hi].tobytes(), "times": times[lo:hi].astype(np.int64).tobytes(),
                   "best": best[lo:hi].tobytes(), "known": known[lo:hi].tobytes()}

    def judge(table: pa.Table) -> pa.Table:
        """Size and largest id of each identity; ``here`` where the first chunk that has it is the row's."""
        cols = {c: [x.as_buffer() for k in table.column(c).chunks for x in k] for c in ("keys", "times", "best", "known")}
        keys, times, best, known = (np.concatenate([np.frombuffer(x, t) for x in cols[c]]) for c, t in
                                    (("keys", f"S{PAIR}"), ("times", np.int64), ("best", np.int64), ("known", bool)))
        many = [len(x) // PAIR for x in cols["keys"]]
        chunk = np.repeat(np.array(table.column("chunk").to_pylist(), np.int64), many)
        _, at = np.unique(keys, return_inverse=True)
        order = np.lexsort((-chunk, best, known, at))
        last = order[np.r_[at[order][1:] != at[order][:-1], True]]
        size = np.zeros(len(last), np.int64)
        np.add.at(size, at, times)
        here = last[at] == np.arange(len(at))
        cut = np.cumsum(many)[:-1]
        out = table.select(["bucket", "chunk"])
        for name, x in (("times", size[at]), ("best", best[last][at]), ("known", known[last][at]), ("here", here)):
            out = out.append_column(name, pa.array([p.tobytes() for p in np.split(x, cut)], pa.binary()))
        return out

    def result(row: dict) -> Iterator[dict]:
        at, last = _identities(row)[2], _best(row)[5]
        size, best, known, here = (_joined(row["got"], c, t) for c, t in (("times", np.int64), ("best", np.int64), ("known", bool), ("here", bool)))
        digests = bytes(row["digests"])
        for i, (doc_id, k) in enumerate(zip(row["doc_ids"], at.tolist(), strict=True)):
            yield {"doc_id": doc_id, "keep_id": int(best[k]) if known[k] else None, "group_size": int(size[k]),
                   "kept": bool(here[k] and last[k] == i), "text_sha256": digests[32 * i:32 * i + 32].hex()}

    first = written(_first(docs, block, chunk_bytes, buckets), "naming-blocks", partition_by="kind")
    heads = first.filter("kind = 0").select("chunk", "doc_ids", "sizes", "digests", "at")
    state = written(_rows(_with(heads.select("chunk", "sizes", "at"), _named(first.filter("kind = 1"), block), "names"), start, STATE_DDL, STATE),
                    "naming-round", partition_by="open")
    ends = state.filter("not open")
    while state.filter("open").limit(1).count():
        left = state.filter("open")
        state = written(_rows(_with(left, _named(_rows(left.select("chunk", "counts", "names"), deal, DEALT_DDL, DEALT), PAIR), "names"), step, STATE_DDL, STATE),
                        "naming-round", partition_by="open")
        ends = ends.unionByName(state.filter("not open"))
    whole = written(_by_chunk(heads.select("chunk", "doc_ids", "sizes", "digests"), ends.select("chunk", "docs", "names")), "naming-ends")
    drop_written(first)
    groups = _rows(whole.select("chunk", "doc_ids", "sizes", "ends"), claim, CLAIM_DDL, CLAIM).groupBy("bucket").applyInArrow(judge, GROUP_DDL)
    return _rows(_with(whole, groups, "times", "best", "known", "here"), result, OUT_DDL, OUT)
