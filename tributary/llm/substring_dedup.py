"""Substring dedup with fixed-block anchors.

A repeat of ``window`` words covers, in either copy, a whole block of
``block`` = (window + 1) // 2 words out of those that tile its document from
the start. So the blocks are indexed, every rolling window of ``block`` words
probes the index, and a probe that meets a block of another place is an
anchor. Anchors are extended: of the ``window``-word windows that hold an
anchor, those whose content another such window shares are repeated, and the
words that they cover are the maximal exact repeats. Extending goes by content
(96-bit hashes, counted), so a passage with many copies makes no pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tributary.llm import chunks as C
from tributary.llm.common import written

WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
PROBES_DDL = "bucket long, chunk long, keys binary, own binary"
PROBES = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("own", pa.binary())])


LONG = 512


def word_hashes(content: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each word's bytes: 8 of them at a time go through a bijection
    that spreads their bits (no polynomial, which periodic texts could defeat);
    words of more than ``LONG`` bytes go through XXH3."""
    size = end - start
    out = C.mix(C.mix(size.astype(np.uint64) + C.ONE) ^ np.uint64(seed))
    padded = np.concatenate([content, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    at, step = np.flatnonzero(size <= LONG), 0
    while len(at):
        value = np.ascontiguousarray(eight[start[at] + 8 * step]).view(np.uint64).ravel()
        left = np.minimum(8, size[at] - 8 * step).astype(np.uint64) * np.uint64(8)
        value = value << (np.uint64(64) - left)
        out[at] = C.mix(out[at] ^ value) + np.uint64(step + 1)
        step += 1
        at = at[size[at] > 8 * step]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(content[start[i]:end[i]], seed)
    return out


class Words:
    """Words of a chunk: byte ranges, hashes (an independent one for each base), and the first word of each document."""

    def __init__(self, content: np.ndarray, sizes: list[int]):
        word = ~WHITE[content]
        step = np.diff(np.r_[False, word, False].view(np.int8))
        self.content, self.start, self.end = content, np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        offset = np.r_[0, np.cumsum(np.array(sizes, np.int64) + 1)]
        self.first = np.searchsorted(self.start, offset)
        self.count = len(self.start)
        self.sums: dict[int, np.ndarray] = {}

    def windows(self, n: int) -> np.ndarray:
        """Words at which a window of n words of one document starts."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        return np.flatnonzero(last - np.arange(self.count) >= n)

    def window_hash(self, start: np.ndarray, n: int, base: int) -> np.ndarray:
        if base not in self.sums:
            self.sums[base] = C.prefix(word_hashes(self.content, self.start, self.end, base), base)
        return C.mix(C.span_hash(self.sums[base], start, start + n, base))


class Anchors:
    """Distinct rolling windows of a chunk in hash order (``keys``), how many
    blocks of the chunk equal each (``own``, 2 for more), and what an answer
    says about the windows of ``window`` words."""

    def __init__(self, row: dict, window: int):
        self.window, self.block = window, (window + 1) // 2
        self.words = w = Words(row["content"], row["sizes"])
        self.at = w.windows(self.block)
        begin = np.repeat(w.first[:-1], np.diff(w.first))[self.at]
        self.aligned = (self.at - begin) % self.block == 0
        self.keys, self.inverse = np.unique(w.window_hash(self.at, self.block, C.BASES[0]), return_inverse=True)
        self.own = np.minimum(2, np.bincount(self.inverse[self.aligned], minlength=len(self.keys))).astype(np.uint8)

    def candidates(self, blocks: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor; blocks: how many there are of each key."""
        hit = self.at[blocks[self.inverse] > self.aligned]
        near = np.zeros(self.words.count + 1, np.int64)
        np.add.at(near, np.maximum(0, hit - (self.window - self.block)), 1)
        np.add.at(near, hit + 1, -1)
        start = self.words.windows(self.window)
        return start[np.cumsum(near)[start] > 0]

    def contents(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contents of windows: two hashes, 1 if repeated here, and each window's number."""
        first = self.words.window_hash(start, self.window, C.BASES[0])
        keys, one, inverse, times = np.unique(first, return_index=True, return_inverse=True, return_counts=True)
        second = self.words.window_hash(start[one], self.window, C.BASES[1]).astype(np.uint32)
        return keys, second, (times > 1).astype(np.uint8), inverse


def count_blocks(cols: dict) -> list[np.ndarray]:
    """For ``by_bucket``: the number of blocks (2 for more) that equal each probe."""
    keys = [np.frombuffer(x, np.uint32) for x in cols["keys"]]
    own = [np.frombuffer(x, np.uint8) for x in cols["own"]]
    blocks = np.concatenate([k[o > 0] for k, o in zip(keys, own, strict=True)])
    blocks, inverse = np.unique(blocks, return_inverse=True)
    if not len(blocks):
        return [np.zeros(len(k), np.uint8) for k in keys]
    many = np.minimum(2, np.bincount(inverse, np.concatenate([o[o > 0] for o in own]))).astype(np.uint8)
    out = []
    for k in keys:
        at = np.minimum(np.searchsorted(blocks, k), len(blocks) - 1)
        out.append(np.where(blocks[at] == k, many[at], 0).astype(np.uint8))
    return out


def substring_dedup(docs: DataFrame, window: int = 35, chunk_bytes: int = 2 << 20, bucket_bytes: int = 4 << 20) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, n_removed, kept (the words left,
    joined by one space), one row for each row.

    Words are runs of anything but ASCII white space. A word is removed if a
    window of ``window`` words that covers it has its word sequence elsewhere,
    in the same document or another; the input decides, not what is left. A
    null or blank text has no words; a text shorter than the window keeps
    all. Repeated rows and equal ids are documents of their own. Extra columns
    are not read; an empty table gives an empty result.

    Three passes over the chunk table; its texts are never shuffled. Probes
    are 4 bytes and a bucket's share of the hash (a false anchor costs a
    candidate, no wrong result), contents 96 bits and the bucket's share, of two
    hashes that share no word hash. Windows are no longer than 1,023 words
    (sums of that few terms modulo 2^64 know no periodic pattern that cancels). For
    larger inputs raise chunk_bytes and bucket_bytes together, so that a row
    between a chunk and a bucket stays full.
    """
    if not 1 <= window < 1024:
        raise ValueError("window must be from 1 to 1023 words")
    chunks = C.pack(docs, b"\n", chunk_bytes)
    buckets = C.bucket_count(chunks, bucket_bytes)

    def probe(row):
        a = Anchors(row, window)
        low = a.keys.astype(np.uint32)
        for b, lo, hi in C.bucket_bounds(a.keys, buckets):
            yield {"bucket": b, "chunk": row["chunk"], "keys": low[lo:hi].tobytes(), "own": a.own[lo:hi].tobytes()}

    def extend(row):
        a = Anchors(row, window)
        keys, second, own, _ = a.contents(a.candidates(C.placed(a.keys, buckets, row["anchors"])))
        for b, lo, hi in C.bucket_bounds(keys, buckets):
            yield {"bucket": b, "chunk": row["chunk"], "first": keys[lo:hi].tobytes(), "second": second[lo:hi].tobytes(), "own": own[lo:hi].tobytes()}

    def remove(row):
        words, covered = None, None
        if row["repeats"]:
            a = Anchors(row, window)
            start = a.candidates(C.placed(a.keys, buckets, row["anchors"]))
            keys, _, _, inverse = a.contents(start)
            start = start[C.placed(keys, buckets, row["repeats"])[inverse] > 0]
            words, cover = a.words, np.zeros(a.words.count + 1, np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + window, -1)
            covered = np.cumsum(cover)[:-1] > 0
        content, at = row["content"].tobytes(), 0
        for i, (doc_id, size) in enumerate(zip(row["doc_ids"], row["sizes"], strict=True)):
            kept = content[at:at + size].split()
            at += size + 1
            n, gone = len(kept), 0
            if words is not None:
                out = covered[words.first[i]:words.first[i + 1]]
                gone = int(out.sum())
                if gone:
                    kept = [w for w, x in zip(kept, out.tolist(), strict=True) if not x]
            yield {"doc_id": doc_id, "n_words": n, "n_removed": gone, "kept": b" ".join(kept).decode()}

    anchors = written(C.by_bucket(C.map_chunks(chunks, probe, PROBES_DDL, PROBES), count_blocks, ["keys", "own"]), "substring-anchors")
    found = C.with_answers(chunks, anchors=anchors)
    repeats = written(C.by_bucket(C.map_chunks(found, extend, C.KEYS_DDL, C.KEYS), C.repeated_keys, ["first", "second", "own"]), "substring-repeats")
    final = C.with_answers(chunks, anchors=anchors, repeats=repeats)
    return C.map_chunks(final, remove, "doc_id long, n_words long, n_removed long, kept string",
                        pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))
