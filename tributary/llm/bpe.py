"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved down to leaves; a node joins its halves' tokens by encoding
anew only a window around the seam. The window grows until it meets, on either
side, a place where tokens provably do not change: before a single space with
a non-space on either side no match of the pattern runs across, whatever
surrounds it (see ``token_counts``), so the left half's tokens before the place
and the right half's tokens after it are those of the whole. Without such a
place the window grows to the whole node. Decoding concatenates up a tree over
the ids.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.common import map_rows

DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
IDS_DDL = "doc_id long, ids array<int>"
IDS_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


class TreeCodec:
    def __init__(self, path: str, pattern: str, leaf: int = 8192, window: int = 64):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.leaf, self.window = max(2, leaf), window
        self.size = [0] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.size[i] = len(token)
        self.name = [str(i) for i in range(len(self.size))]

    def stable_before(self, text: str, lo: int, cut: int) -> int:
        """The last stable place in (lo, cut), else -1."""
        at = text.rfind(" ", lo, cut)
        while at > lo:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                return at
            at = text.rfind(" ", lo, at)
        return -1

    def stable_after(self, text: str, cut: int, hi: int) -> int:
        """The first stable place in (cut, hi - 1), else -1."""
        at = text.find(" ", cut + 1, hi - 1)
        while at >= 0:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                return at
            at = text.find(" ", at + 1, hi - 1)
        return -1

    def encode(self, text: str, lo: int = 0, hi: int | None = None) -> list[int]:
        hi = len(text) if hi is None else hi
        if hi - lo <= self.leaf:
            return self.enc.encode_ordinary(text[lo:hi])
        cut = (lo + hi) // 2
        return self.join(text, lo, cut, hi, self.encode(text, lo, cut), self.encode(text, cut, hi))

    def join(self, text: str, lo: int, cut: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        width, x = self.window, -1
        while x < 0 and width < cut - lo:
            x, width = self.stable_before(text, cut - width, cut), width * 2
        x = lo if x < 0 else x
        width, y = self.window, -1
        while y < 0 and width < hi - cut:
            y, width = self.stable_after(text, cut, cut + width), width * 2
        y = hi if y < 0 else y
        keep, out = len(left), len(text[x:cut].encode())
        while out > 0:
            keep -= 1
            out -= self.size[left[keep]]
        skip, over = 0, len(text[cut:y].encode())
        while over > 0:
            over -= self.size[right[skip]]
            skip += 1
        if out or over:  # cannot happen at stable places; whole node for safety
            return self.enc.encode_ordinary(text[lo:hi])
        return left[:keep] + self.enc.encode_ordinary(text[x:y]) + right[skip:]

    def decode(self, ids: list[int], lo: int = 0, hi: int | None = None) -> bytes:
        hi = len(ids) if hi is None else hi
        if hi - lo <= self.leaf:
            return self.enc.decode_bytes(ids[lo:hi])
        cut = (lo + hi) // 2
        return self.decode(ids, lo, cut) + self.decode(ids, cut, hi)


@lru_cache(maxsize=2)  # once in a Python worker, not in every task
def _codec(vocabulary: str, path: str | None, pattern: str | None, leaf: int) -> TreeCodec:
    import public_tokenizers

    return TreeCodec(path or public_tokenizers.path(vocabulary), pattern or public_tokenizers.PATTERN, leaf)


def encode_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", path: str | None = None,
                     pattern: str | None = None, leaf: int = 8192) -> DataFrame:
    """docs (doc_id, text) -> doc_id, ids. A null text has no ids."""

    def make():
        codec = _codec(vocabulary, path, pattern, leaf)
        return lambda row: (row[0], codec.encode(row[1] or ""))

    return map_rows(docs.select("doc_id", "text"), make, IDS_DDL, IDS_ARROW)


def decode_documents(encoded: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", path: str | None = None,
                     pattern: str | None = None, leaf: int = 8192) -> DataFrame:
    """encoded (doc_id, ids) -> doc_id, content (bytes). Null ids give no bytes."""

    def make():
        codec = _codec(vocabulary, path, pattern, leaf)
        return lambda row: (row[0], codec.decode(row[1] or []))

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, content binary", pa.schema([("doc_id", pa.int64()), ("content", pa.binary())]))


def bpe_round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", path: str | None = None,
                   pattern: str | None = None, leaf: int = 8192) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256:
    every text encoded, its ids decoded again, both as digests.

    A null text counts as empty (0 tokens, digests of nothing). Repeated rows
    stay, extra columns are not read, an empty table gives an empty result.
    """

    def make():
        codec = _codec(vocabulary, path, pattern, leaf)

        def one(row):
            ids = codec.encode(row[1] or "")
            written = " ".join(map(codec.name.__getitem__, ids))
            return row[0], len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

        return one

    return map_rows(docs.select("doc_id", "text"), make, DDL, ARROW)
