"""SimHash near-duplicates with BK-trees.

Fingerprints within ``radius`` bits of each other agree, by pigeonhole, in at
least ``equal`` of ``radius + equal`` blocks. For each choice of ``equal``
blocks the distinct fingerprints with the same bits there form a shard. Every
shard has a BK-tree, whose children are keyed by their Hamming distance to the
parent, and its members are searched in it along edges within the radius. A
shard above ``tree_size`` members is cut into several trees, each of which
meets every part of the shard in a task of its own. A task sends on the links'
spanning forest only, so no group is expanded into pairs.

A tree and its queries travel together to one task instead of being broadcast
to all: trees over all fingerprints have no size bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import map_rows, written
from tributary.llm.components import components, spanning

PAIRS = 1 << 18


def fingerprint(text: str, shingle: int, seed: int = 42) -> int:
    """A bit is 1 if set in over half of the XXH64 hashes of the shingles."""
    import xxhash

    words = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    at = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
    digest, n, ones = xxhash.xxh64_digest, len(words) - shingle + 1, np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        hi = min(n, lo + 65536)
        raw = b"".join([digest(joined[a:b - 1], seed) for a, b in zip(at[lo:hi], at[lo + shingle:hi + shingle], strict=True)])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp: the 64-bit fingerprint as a signed long."""

    def make():
        def one(row):
            f = fingerprint(row[1] or "", shingle)
            return row[0], f - (1 << 64) if f >> 63 else f

        return one

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, fp long", pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())]))


def shard_keys(fp: str, radius: int, equal: int) -> list:
    """One key for each choice of ``equal`` blocks: its number and the bits of the blocks."""
    n = radius + equal
    cuts = [64 * i // n for i in range(n + 1)]
    out = []
    for k, chosen in enumerate(combinations(range(n), equal)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        mask = mask - (1 << 64) if mask >> 63 else mask
        out.append(F.struct(F.lit(k).alias("table"), F.col(fp).bitwiseAND(F.lit(mask)).alias("bits")))
    return out


def forest(shard: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all shards at once; ``shard`` numbers them from 0, sorted.
    Returns the root of each shard, and the children by parent: first (offsets),
    child and its distance to the parent. All members of a level descend together."""
    n = len(fp)
    root = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else np.zeros(0, np.int64)
    cur, going = root[shard], np.setdiff1d(np.arange(n), root)
    parent, edge = np.full(n, -1), np.zeros(n, np.int64)
    while len(going):
        d = np.bitwise_count(fp[going] ^ fp[cur[going]]).astype(np.int64)
        _, first, which = np.unique(cur[going] * 65 + d, return_index=True, return_inverse=True)
        child = going[first]
        parent[child], edge[child] = cur[child], d[first]
        cur[going] = child[which]
        stay = np.ones(len(going), bool)
        stay[first] = False
        going = going[stay]
    order = np.argsort(parent, kind="stable")
    order = order[np.searchsorted(parent[order], 0):]
    return root, np.searchsorted(parent[order], np.arange(n + 1)), order, edge[order]


def within(tree: tuple, fp: np.ndarray, query_fp: np.ndarray, query_shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) at most ``radius`` bits apart, along edges within the radius."""
    root, first, child, edge = tree
    q, node = np.arange(len(query_fp)), root[query_shard]
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    while len(q):
        d = np.bitwise_count(query_fp[q] ^ fp[node]).astype(np.int64)
        near = d <= radius
        hits.append((q[near], node[near]))
        many = first[node + 1] - first[node]
        at = np.repeat(first[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
        q, d = np.repeat(q, many), np.repeat(d, many)
        follow = np.abs(edge[at] - d) <= radius
        q, node = q[follow], child[at[follow]]
    return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def link_edges(members: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """members (shard columns, fp, i, j, tree, query) -> edges (a, b) that
    span the links of each task. Rows come sorted by shard; a shard that
    goes over the end of a batch is carried to the next."""
    names = ["table", "bits", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table) -> pa.RecordBatch:
            cols = [t.column(c).to_numpy() for c in names]
            new = np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)]
            shard, fp = np.cumsum(new) - 1, t.column("fp").to_numpy().view(np.uint64)
            is_tree, is_query = t.column("tree").to_numpy(), t.column("query").to_numpy()
            tf, ts = fp[is_tree], shard[is_tree]
            have, ts = np.unique(ts, return_inverse=True)  # shards that have a tree here
            place = np.searchsorted(have, shard[is_query])
            ok = (place < len(have)) & (have[np.minimum(place, len(have) - 1)] == shard[is_query]) if len(have) else np.zeros(int(is_query.sum()), bool)
            qf, qs = fp[is_query][ok], place[ok]
            grown, a, b = forest(ts, tf), [], []
            largest = int(np.bincount(ts).max()) if len(ts) else 1
            step = max(16, PAIRS // largest)  # bounds the pairs on the way, in a dense shard all of them
            for lo in range(0, len(qf), step):
                x, y = within(grown, tf, qf[lo:lo + step], qs[lo:lo + step], radius)
                x = qf[lo:lo + step][x]
                differ = x != tf[y]
                p, r = spanning(x[differ].view(np.int64), tf[y][differ].view(np.int64))
                a.append(p)
                b.append(r)
            a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if not t.num_rows:
                continue
            cols = [t.column(c).to_numpy() for c in names]
            last = np.all([c == c[-1] for c in cols], axis=0)
            cut = int(np.argmax(last))
            rest = t.slice(cut)
            if cut:
                yield solve(t.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return members.mapInArrow(run, "a long, b long")


def near_links(distinct: DataFrame, radius: int = 4, equal: int = 2, tree_size: int = 2048) -> DataFrame:
    """distinct (fp) -> edges (a, b) that join all fingerprints reachable by links."""
    keyed = distinct.select("fp", F.explode(F.array(*shard_keys("fp", radius, equal))).alias("k")).select("fp", "k.table", "k.bits")
    full = keyed.groupBy("table", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    some = keyed.join(full, ["table", "bits"]).withColumn("parts", F.ceil(F.col("n") / tree_size).cast("long"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    some = some.withColumn("part", part).select("table", "bits", "fp", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    some = some.select("table", "bits", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp",
                       (F.col("part") <= F.col("other")).alias("tree"), (F.col("part") >= F.col("other")).alias("query"))
    dealt = some.repartition("table", "bits", "i", "j").sortWithinPartitions("table", "bits", "i", "j")
    return link_edges(dealt, radius, tree_size)


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, equal: int = 2, tree_size: int = 2048) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fingerprint (16 hex digits), component_id
    (smallest id that a document reaches through links), one row for each row.

    A text without words, null included, has fingerprint zero and links like
    any other. Equal fingerprints are one node, so exact copies cost nothing
    more. A null id takes part; a component of null ids only has a null id.
    Repeated rows stay, extra columns are not read, an empty table gives an
    empty result.
    """
    fps = written(fingerprints(docs, shingle), "simhash-fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = components(written(near_links(nodes.select("fp"), radius, equal, tree_size), "simhash-edges"))
    known = nodes.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    known = written(known, "simhash-nodes")
    smallest = known.groupBy("label").agg(F.min("first").alias("component_id"))
    named = known.join(smallest, "label").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
