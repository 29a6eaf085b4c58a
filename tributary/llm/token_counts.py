"""Token counts by overlap resynchronisation.

A huge text is cut into overlapping chunks. Every chunk is encoded with the
offsets of its stable boundaries, and neighbouring chunks are spliced at a
boundary that both have. Where the overlap holds no common boundary it is
widened, at last to the splice before; the chunk that starts there reaches
twice as far each time, so a stretch without boundaries is encoded in
proportion to its length, however long it is.

A boundary is proven stable when the byte-level pattern (letters, digits or
other symbols, each with one optional leading space, or white space; and
contractions, an apostrophe with letters) never lets a match run across it,
whatever text surrounds it, and no special string holds it. That is so before a
single space with a non-space on either side, since special strings hold no
space. In pieces between such places that are long (texts without spaces,
encoded data) there are more: where white space follows, and where a letter, a
digit and a symbol other than the apostrophe meet, outside special strings. A
special string that a chunk's end cuts is whole in the other chunk, as it is
shorter than the overlap, so no splice falls inside one. Tokens left of a
boundary depend on the text left of it only, tokens right of it on the text
right of it. For the same reason the pieces between stable boundaries are
encoded once each and remembered: the count of a chunk is the sum over its
pieces.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.common import map_rows

STABLE = re.compile(r"(?<=\S)(?= \S)")
LONG = 256
#: Characters that are letters or symbols in every version of the pattern's classes.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿА-Яа-яぁ-んァ-ヴ一-龥가-힣"
SYMBOLS = r"!-&(-/:-@\[-`{-~、。「」！？，：；（）"
FINE = re.compile(f"(?<=[{LETTERS}])(?=[0-9'{SYMBOLS} \\t\\n\\r])|(?<=[0-9])(?=[{LETTERS}'{SYMBOLS} \\t\\n\\r])|(?<=[{SYMBOLS}])(?=[{LETTERS}0-9 \\t\\n\\r])")
DDL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


class PieceEncoder:
    """Tokens of pieces by the tokenizers library, each distinct piece encoded
    once; the memory of pieces is emptied when it reaches ``memo`` entries."""

    def __init__(self, path: str, memo: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.most, self.memo = Tokenizer.from_file(path), memo, {}
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.widest = max(map(len, special), default=1)

    def pieces(self, text: str) -> list[str]:
        """The text between stable boundaries."""
        out = []
        for p in STABLE.split(text):
            if len(p) <= LONG:
                out.append(p)
                continue
            at = 0  # special strings stay whole
            for m in self.special.finditer(p) if self.special else ():
                out += FINE.split(p[at:m.start()]) if m.start() > at else []
                out.append(m.group())
                at = m.end()
            out += FINE.split(p[at:]) if at < len(p) else []
        return out

    def counts(self, pieces: list[str]) -> list[int]:
        """Token counts of pieces."""
        memo = self.memo
        if len(memo) > self.most:
            memo.clear()
        if new := list({p for p in pieces if p not in memo and len(p) <= 65}):
            memo.update(zip(new, map(len, self.tok.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        return [memo[p] if len(p) <= 65 else len(self.tok.encode(p, add_special_tokens=False)) for p in pieces]


def chunk_boundaries(encoder: PieceEncoder, text: str, start: int, end: int) -> tuple[list[int], list[int]]:
    """Stable boundaries of text[start:end] (offsets in the whole text) and the
    tokens before each; the last entry stands for the chunk's end."""
    pieces = encoder.pieces(text[start:end])
    at, before, offsets, total = start, 0, [], []
    for p, n in zip(pieces, encoder.counts(pieces), strict=True):
        at += len(p)
        before += n
        offsets.append(at)
        total.append(before)
    return offsets, total


def count_tokens(encoder: PieceEncoder, text: str, chunk: int, overlap: int) -> int:
    """Tokens of the whole text. Chunks cover [start, end); ``base`` is the
    stable boundary up to which tokens are counted."""
    if len(text) <= chunk:
        return sum(encoder.counts(encoder.pieces(text))) if text else 0
    base, done, reach, overlap = 0, 0, chunk, max(overlap, 2 * encoder.widest)
    end = chunk
    left = chunk_boundaries(encoder, text, 0, end)
    while end < len(text):
        # wide enough for a boundary that the left chunk has, if it has one
        width = max(overlap, end - left[0][-2] + overlap // 2) if len(left[0]) > 1 else end - base
        while True:
            if end - width <= base:  # all the way back: reach on as far
                reach = max(reach, end - base)
            start, new_end = max(base, end - width), min(len(text), end + reach)
            right = chunk_boundaries(encoder, text, start, new_end)
            if start == base:  # widened to the last splice: nothing of the left chunk is needed
                left, reach = right, 2 * reach
                break
            common = set(right[0][:-1]).intersection(left[0][:-1])
            if common:
                x = min(common)
                done += left[1][left[0].index(x)]
                skipped = right[1][right[0].index(x)]
                keep = [(o, t - skipped) for o, t in zip(*right, strict=True) if o > x]
                left, base, reach = ([o for o, _ in keep], [t for _, t in keep]), x, chunk
                break
            width *= 2
        end = new_end
    return done + left[1][-1]


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", path: str | None = None, limit: int = 1024,
                 chunk: int = 32768, overlap: int = 1024, memo: int = 300_000) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit, one row
    for each row.

    ``vocabulary`` names a byte-level BPE file of ``public_tokenizers``;
    ``path`` gives a file of one's own instead (readable on every executor).
    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows stay, extra
    columns are not read, an empty table gives an empty result.
    """

    def make():
        import public_tokenizers

        encoder = PieceEncoder(path or public_tokenizers.path(vocabulary), memo)

        def one(row):
            text = row[1] or ""
            n = count_tokens(encoder, text, chunk, overlap)
            return row[0], len(text.encode()), n, n > limit

        return one

    return map_rows(docs.select("doc_id", "text"), make, DDL, ARROW)
