"""Suffix-array dedup by column-wise multi-document construction.

Strings of ``length`` bytes that equal each other have the same minimiser (the
least of the hashed 32-byte strings inside, the first of equals), at the same
place. A text is therefore cut into segments: the longest stretches whose
windows of ``length`` bytes share their minimiser. Segments with equal
minimisers are a collection of documents, lined up at the minimiser, and no
window has an equal outside its collection.

A collection's suffixes are sorted column by column from the right: each round
inserts one symbol of every document, a stable sort of the present order by
that symbol (the column of the collection's Burrows-Wheeler transform) gives
the new order, and the common prefixes of neighbours follow from the least
common prefix between their former places. A window is repeated when its
suffix shares ``length`` bytes or more with a neighbour. All collections of a
bucket go through the rounds together.

Equal segments enter a collection once, with their number. A collection of a
single segment needs no sorting: all its windows are repeated if the segment
is. A collection of more than ``most`` different segments would burden one
task; its windows are dealt anew over all buckets, by 96-bit content hash, and
counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import chunks as C
from tributary.llm.common import written

GRAM = 32
TILE = 1 << 16
SINGLE, MEMBER, OWNER, HOT = 1, 2, 3, 4
FIRST_DDL = "bucket long, chunk long, keys binary, segment binary, own binary"
FIRST = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("segment", pa.binary()), ("own", pa.binary())])
TEXT_DDL = FIRST_DDL + ", owner binary, run binary, anchor binary, content binary"
TEXT = pa.schema([*FIRST, ("owner", pa.binary()), ("run", pa.binary()), ("anchor", pa.binary()), ("content", pa.binary())])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = len(v)
    padded = np.full(-(-n // width) * width, np.iinfo(v.dtype).max, v.dtype)
    padded[:n] = v
    rows = padded.reshape(-1, width)
    up = np.minimum.accumulate(rows, axis=1).ravel()
    down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n - width + 1], up[width - 1:n])


class Segments:
    """Segments of a chunk by place (start, run: number of windows, anchor:
    offset of the minimiser, kind: number of the distinct segment), and the
    distinct ones in the order of the minimiser's hash (keys, segment, one: a
    place where it stands, own: 1 if at several)."""

    def __init__(self, row: dict, length: int):
        self.length, self.content = length, row["content"]
        self.offset = np.r_[0, np.cumsum(np.array(row["sizes"], np.int64))]
        total, got = len(self.content), []
        for lo in range(0, max(0, total - length + 1), TILE):
            got.append(self._tile(lo, min(TILE, total - length + 1 - lo)))
        start, run, anchor, key, segment = (np.concatenate(c) for c in zip(*got, strict=True)) if got else (
            *[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2)
        order = np.lexsort((segment, key))
        k, s = key[order], segment[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])] if len(k) else np.zeros(0, bool)
        self.start, self.run, self.anchor = start, run, anchor
        self.kind = np.zeros(len(start), np.int64)
        self.kind[order] = np.cumsum(new) - 1
        self.one, self.keys, self.segment = order[new], k[new], s[new]
        self.own = (np.bincount(self.kind, minlength=len(self.keys)) > 1).astype(np.uint8)

    def _tile(self, lo: int, windows: int) -> tuple:
        length = self.length
        part = self.content[lo:lo + windows + length - 1]
        sums = C.prefix(part.astype(np.uint64) + C.ONE, C.BASES[0])
        inverse = C.powers(C.BASES[0], len(sums))[1]
        hashed = (sums[GRAM:] - sums[:-GRAM]) * inverse[:len(sums) - GRAM]
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(29)
        where = np.arange(len(hashed), dtype=np.uint64)
        least = (sliding_min((hashed & np.uint64(~0x1FFFF & (1 << 64) - 1)) | where, length - GRAM + 1) & np.uint64(0x1FFFF)).astype(np.int64)
        whole = np.ones(windows, bool)
        a, b = np.searchsorted(self.offset, [lo + 1, lo + windows + length - 1])
        for e in (self.offset[a:b] - lo).tolist():  # no window runs over the end of a document
            whole[max(0, e - length + 1):max(0, e)] = False
        change = np.r_[True, (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])]
        edge = np.r_[np.flatnonzero(change), windows]
        start, end = edge[:-1], edge[1:]
        start, end = start[whole[start]], end[whole[start]]
        segment = C.span_hash(sums, start, end + length - 1, C.BASES[0]) + (end - start).astype(np.uint64)
        return start + lo, end - start, least[start] - start, C.mix(hashed[least[start]]), C.mix(segment)

    def windows(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows of the given distinct segments: two hashes, 1 if
        repeated here, and for each window of each segment its number."""
        one = self.one[kinds]
        at = _ranges(self.start[one], self.run[one])
        k1, k2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint32)
        for lo in range(0, len(at), TILE):
            few = at[lo:lo + TILE]
            for base, out in ((C.BASES[0], k1), (C.BASES[1], k2)):
                h = np.zeros(len(few), np.uint64)
                for j in range(self.length):
                    h = h * np.uint64(base) + self.content[few + j] + C.ONE
                out[lo:lo + len(few)] = C.mix(h).astype(out.dtype)
        keys, first, inverse, times = np.unique(k1, return_index=True, return_inverse=True, return_counts=True)
        own = times > 1
        own[inverse[np.repeat(self.own[kinds] > 0, self.run[one])]] = True
        return keys, k2[first], own.astype(np.uint8), inverse


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def repeated_columns(content: np.ndarray, offset: np.ndarray, size: np.ndarray, anchor: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Rounds of the construction over the segments of all groups at once.
    Returns a flag for each window of each segment, segment by segment."""
    run = size - length + 1
    out, at = np.zeros(int(run.sum()), bool), np.cumsum(run) - run
    head, tail = -anchor, size - anchor  # the columns of a segment, from its minimiser
    enter, leave = np.argsort(-tail, kind="stable"), tail  # by their last column
    base, entered = offset + anchor, 0
    order, common = np.zeros(0, np.int64), np.zeros(1, np.int16)  # common[k]: with the one before; one more at the end
    for column in range(int(tail.max()) - 1, int(head.min()) - 1, -1):
        upto = int(np.searchsorted(-leave[enter], -column, side="left"))
        fresh = upto - entered
        if fresh:
            order = np.concatenate([enter[entered:upto], order])
            common = np.concatenate([np.zeros(fresh, np.int16), common])
            entered = upto
        key = (group[order] << 8) | content[base[order] + column]
        turn = np.argsort(key, kind="stable")
        key, order = key[turn], order[turn]
        pair = np.flatnonzero(key[1:] == key[:-1])
        before, after = turn[pair], turn[pair + 1]
        least = common[after]
        far = np.flatnonzero(after != before + 1)
        if len(far):
            cut = np.stack([before[far] + 1, after[far] + 1], axis=1).ravel()
            least[far] = np.minimum.reduceat(common, cut)[::2]
        least[before < fresh] = 0
        common = np.zeros(len(order) + 1, np.int16)
        common[pair + 1] = least + 1
        same = common >= length
        hit = order[same[:-1] | same[1:]]
        out[at[hit] + column - head[hit]] = True
        gone = head[order] == column
        if gone.any():  # what stays has the least common prefix over those that go
            stay = np.flatnonzero(~gone)
            if len(stay):
                kept = np.minimum.reduceat(common[:stay[-1] + 1], np.r_[0, stay[:-1] + 1])
                order, common = order[stay], np.append(kept, np.int16(0))
            else:
                order, common = np.zeros(0, np.int64), np.zeros(1, np.int16)
    return out


def group_segments(most: int):
    """For ``by_bucket``: what becomes of each distinct segment of a chunk."""

    def flags(cols: dict) -> list[np.ndarray]:
        keys = [np.frombuffer(x, np.uint32) for x in cols["keys"]]
        key, segment = np.concatenate(keys), np.concatenate([np.frombuffer(x, np.uint64) for x in cols["segment"]])
        own = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["own"]])
        order = np.lexsort((segment, key))
        k, s = key[order], segment[order]
        new_key = np.r_[True, k[1:] != k[:-1]]
        new = new_key | np.r_[True, s[1:] != s[:-1]]
        group, kind = np.cumsum(new_key) - 1, np.cumsum(new) - 1
        different = np.bincount(group, new)[group]
        times = np.bincount(kind, 1 + own[order])[kind]
        state = np.where(different > most, HOT, np.where(different > 1, np.where(new, OWNER, MEMBER), np.where(times > 1, SINGLE, 0)))
        out = np.zeros(len(order), np.uint8)
        out[order] = state
        return np.split(out, np.cumsum([len(x) for x in keys])[:-1])

    return flags


def sort_collections(length: int):
    """For ``by_bucket``: the repeated windows of each chunk's segments, as packed bits."""

    def flags(cols: dict) -> list[np.ndarray]:
        keys = [np.frombuffer(x, np.uint32) for x in cols["keys"]]
        cat = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in cols[c]])
        key, segment, own, owner = np.concatenate(keys), cat("segment", np.uint64), cat("own", np.uint8), cat("owner", np.uint8) > 0
        run, anchor = cat("run", np.uint8).astype(np.int64), cat("anchor", np.uint8).astype(np.int64)
        order = np.lexsort((~owner, segment, key))  # the owner first
        k, s = key[order], segment[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])]
        kind = np.cumsum(new) - 1
        first = order[new]
        size = run + length - 1
        place = np.cumsum(np.where(owner, size, 0)) - np.where(owner, size, 0)  # of the owner's bytes
        group = np.cumsum(np.r_[True, key[first][1:] != key[first][:-1]]) - 1
        content = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["content"]])
        found = repeated_columns(content, place[first], size[first], anchor[first], group, length)
        many = np.bincount(kind, 1 + own[order]) > 1
        found |= np.repeat(many, run[first])
        at = np.cumsum(run[first]) - run[first]
        of = np.zeros(len(order), np.int64)
        of[order] = kind
        bits = found[_ranges(at[of], run)]
        ends = np.cumsum(run)[np.cumsum([len(x) for x in keys]) - 1]
        return [np.packbits(x) for x in np.split(bits, ends[:-1])]

    return flags


def suffix_dedup(docs: DataFrame, length: int = 200, most: int = 1 << 16, carry: tuple[str, ...] = (), as_text: bool = False,
                 chunk_bytes: int = 2 << 20, bucket_bytes: int = 4 << 20) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept (the
    bytes left; with ``as_text`` a string, without the rest of a character of
    which only some bytes are left), and ``carried`` (a struct of the columns
    named in ``carry``); one row for each row.

    A byte is removed if a string of ``length`` bytes (64 to 255 + 31) that
    covers it starts elsewhere too, in the same text or another; matches never
    cross texts; the input decides, not what is left. ``n_spans`` counts the
    maximal removed runs of a text. A null text is empty, a text shorter than
    ``length`` keeps all. Repeated rows and equal ids are texts of their own.
    Extra columns are not read; an empty table gives an empty result.

    Three passes over the chunk table; its texts are never shuffled, only the
    segments of collections with different members, one copy of each.
    """
    if not 2 * GRAM <= length <= 286:
        raise ValueError("length must be from 64 to 286 bytes")
    chunks = C.pack(docs, b"", chunk_bytes, carry)
    buckets = C.bucket_count(chunks, bucket_bytes)

    def name(row):
        s = Segments(row, length)
        for b, lo, hi in C.bucket_bounds(s.keys, buckets):
            yield {"bucket": b, "chunk": row["chunk"], "keys": s.keys[lo:hi].astype(np.uint32).tobytes(),
                   "segment": s.segment[lo:hi].tobytes(), "own": s.own[lo:hi].tobytes()}

    def send(row):
        if not row["named"]:
            return
        s = Segments(row, length)
        state = C.placed(s.keys, buckets, row["named"])
        for b, lo, hi in C.bucket_bounds(s.keys, buckets):
            few = lo + np.flatnonzero((state[lo:hi] == MEMBER) | (state[lo:hi] == OWNER))
            if len(few):
                owner, one = state[few] == OWNER, s.one[few]
                mine = one[owner]
                yield {"bucket": b, "chunk": row["chunk"], "keys": s.keys[few].astype(np.uint32).tobytes(), "segment": s.segment[few].tobytes(),
                       "own": s.own[few].tobytes(), "owner": owner.astype(np.uint8).tobytes(), "run": s.run[one].astype(np.uint8).tobytes(),
                       "anchor": s.anchor[one].astype(np.uint8).tobytes(), "content": s.content[_ranges(s.start[mine], s.run[mine] + length - 1)].tobytes()}

    def send_hot(row):
        s = Segments(row, length)
        keys, second, own, _ = s.windows(np.flatnonzero(C.placed(s.keys, buckets, row["named"]) == HOT))
        for b, lo, hi in C.bucket_bounds(keys, buckets):
            yield {"bucket": b, "chunk": row["chunk"], "first": keys[lo:hi].tobytes(), "second": second[lo:hi].tobytes(), "own": own[lo:hi].tobytes()}

    def remove(row):
        content, sizes = row["content"], np.array(row["sizes"], np.int64)
        gone, offset = np.zeros(len(content), bool), np.r_[0, np.cumsum(sizes)]
        if row["named"]:
            s = Segments(row, length)
            state, run = C.placed(s.keys, buckets, row["named"]), s.run[s.one]
            at = np.cumsum(run) - run
            hit = np.repeat(state == SINGLE, run)
            sorted_bits = {a["bucket"]: a["flags"] for a in row["sorted"] or ()}
            for b, lo, hi in C.bucket_bounds(s.keys, buckets):
                if b in sorted_bits:
                    few = lo + np.flatnonzero((state[lo:hi] == MEMBER) | (state[lo:hi] == OWNER))
                    hit[_ranges(at[few], run[few])] = np.unpackbits(np.frombuffer(sorted_bits[b], np.uint8), count=int(run[few].sum())) > 0
            if row["hot"]:
                few = np.flatnonzero(state == HOT)
                keys, _, _, inverse = s.windows(few)
                hit[_ranges(at[few], run[few])] = C.placed(keys, buckets, row["hot"])[inverse] > 0
            window = _ranges(s.start, s.run)[hit[_ranges(at[s.kind], s.run)]]
            cover = np.bincount(window, minlength=len(content) + 1) - np.bincount(window + length, minlength=len(content) + 1)[:len(content) + 1]
            gone = np.cumsum(cover)[:-1] > 0
        first = gone & ~np.r_[False, gone[:-1]]
        inside = offset[:-1][sizes > 0]
        first[inside] = gone[inside]
        removed, spans = (np.r_[0, np.cumsum(x)][offset] for x in (gone, first))
        left = content[~gone].tobytes()
        for i, doc_id in enumerate(row["doc_ids"]):
            kept = left[offset[i] - removed[i]:offset[i + 1] - removed[i + 1]]
            yield {"doc_id": doc_id, "n_bytes": int(sizes[i]), "n_removed": int(removed[i + 1] - removed[i]), "n_spans": int(spans[i + 1] - spans[i]),
                   "kept": kept.decode(errors="ignore") if as_text else kept, **({"carried": row["carried"][i]} if carry else {})}

    named = written(C.by_bucket(C.map_chunks(chunks, name, FIRST_DDL, FIRST), group_segments(most), ["keys", "segment", "own"]), "suffix-named")
    known = C.with_answers(chunks, named=named)
    done = written(C.by_bucket(C.map_chunks(known, send, TEXT_DDL, TEXT), sort_collections(length), [f.name for f in TEXT][2:]), "suffix-sorted")
    some_hot = named.filter(F.instr(F.hex("flags"), "04") > 0).limit(1).count()
    hot = C.by_bucket(C.map_chunks(known, send_hot, C.KEYS_DDL, C.KEYS), C.repeated_keys, ["first", "second", "own"]) if some_hot else done.limit(0)
    final = C.with_answers(chunks, named=named, sorted=done, hot=written(hot, "suffix-hot"))
    ddl = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"
    schema = [*((c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")), ("kept", pa.string() if as_text else pa.binary())]
    if carry:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = chunks.schema["carried"].dataType.elementType
        ddl, schema = f"{ddl}, carried {kind.simpleString()}", [*schema, ("carried", to_arrow_type(kind))]
    return C.map_chunks(final, remove, ddl, pa.schema(schema))
