"""Embedding near-dedup on a robust-pruned flat graph.

Distinct vectors of a label go to the shards of their ``overlap`` nearest
clusters. Every block of a shard gets a graph: each vector's nearest ones,
pruned so that no edge stands in for a shorter way (robust prune). Adjacency
lists of a vector from all its shards are united. Then each vector searches
the blocks of its shards: greedily with a beam from the medoids of the graph's
connected parts, and from what lies in range on to all that is in range. Links are verified in double
precision, and the recall is audited by brute force for a bounded sample of
vectors. It is judged by vector, not by link, in strata of label and number of
links, so that a dense group does not hide what its neighbours miss. The
clusters of labels that fail overlap more; if they fail at the largest overlap
too, all their pairs of blocks are compared.

A block has a bounded size. A shard of several blocks is searched block by
block, so a label or a cluster of near copies may hold any part of all rows.
Equal vectors are one node with a number. A task returns link counts and a
spanning forest, not pairs; a pair with several common shards counts in the
first of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written
from tributary.llm.components import components, spanning

SHARD = ["label", "dim", "cluster"]
#: The share of a stratum's vectors that may find less than LEAST_SHARE of their links.
LOW_SHARE, LEAST_SHARE = 0.05, 0.9


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(sample: dict, counts: dict, shard_size: int, rounds: int = 6) -> dict:
    """Spherical k-means on each label's sampled vectors; one cluster (no entry)
    where the label is small."""
    out = {}
    for key, x in sample.items():
        k = min(-(-counts.get(key, 0) // shard_size), len(x) // 4)
        if k < 2:
            continue
        x = unit(x)
        c = x[:: max(1, len(x) // k)][:k]
        for _ in range(rounds):
            best = (x @ c.T).argmax(axis=1)
            total = np.zeros_like(c)
            np.add.at(total, best, x)
            size = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
        out[key] = c
    return out


def pruned_graph(x: np.ndarray, degree: int, pool: int, alpha: float) -> np.ndarray:
    """Neighbours of each row (-1: none). Of the ``pool`` nearest, in rounds
    taken by all rows at once: keep the nearest left, and drop those that are
    alpha times closer to it than to the row."""
    n = len(x)
    far = np.maximum(0, 2 - 2 * (x @ x.T)).astype(np.float32)
    np.fill_diagonal(far, np.inf)
    pool = min(pool, n - 1)
    if pool < 1:
        return np.full((n, 1), -1)
    near = np.argpartition(far, pool - 1, axis=1)[:, :pool]
    d = np.take_along_axis(far, near, axis=1)
    out, rows = np.full((n, min(degree, pool)), -1), np.arange(n)
    for step in range(out.shape[1]):
        at = d.argmin(axis=1)
        left = np.isfinite(d[rows, at])
        chosen = near[rows, at]
        out[left, step] = chosen[left]
        d[rows, at] = np.inf
        d[alpha * alpha * far[chosen[:, None], near] <= d] = np.inf
    return out


def united(graph: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Both directions of the edges, so that every node can be reached, as padded lists."""
    n = len(graph)
    a = np.concatenate([np.repeat(np.arange(n), g.shape[1]) for g in (graph, lists) if g.size])
    b = np.concatenate([g.ravel() for g in (graph, lists) if g.size])
    a, b = a[b >= 0], b[b >= 0]
    edge = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = edge // n, edge % n
    many = np.bincount(a, minlength=n)
    out = np.full((n, max(1, int(many.max(initial=0)))), -1)
    out[a, np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)] = b
    return out


def medoids(graph: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The medoid of each connected part of the graph: a dense group whose
    nearest ones are all its own has no way in from outside."""
    at, slot = np.nonzero(graph >= 0)
    node, low = spanning(at, graph[at, slot])
    part = np.arange(len(x))
    part[node] = low
    _, part = np.unique(part, return_inverse=True)
    mean = np.zeros((part.max() + 1, x.shape[1]))
    np.add.at(mean, part, x)
    score = np.einsum("ij,ij->i", x, mean[part])
    order = np.lexsort((-score, part))
    return order[np.r_[True, part[order][1:] != part[order][:-1]]]


def range_search(graph: np.ndarray, x: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) whose product is at least ``floor``: greedy from the
    medoids nearest to the query and from its own node (``own``, -1 if it is
    not of this block), then on from everything found in range until nothing
    is added."""
    n, m, rows = len(x), len(queries), np.arange(len(queries))
    entry = medoids(graph, x)
    x, queries = x.astype(np.float32), queries.astype(np.float32)
    seen, open_ = np.zeros((m, n), bool), np.zeros((m, n), bool)  # open_: in range, neighbours not yet seen
    beam = min(beam, n)
    ids, score = np.full((m, beam), entry[0]), np.full((m, beam), -np.inf, np.float32)
    first = queries @ x[entry].T
    seen[:, entry] = True
    open_[:, entry] = first >= floor
    take = min(len(entry), beam)
    top = np.argpartition(-first, take - 1, axis=1)[:, :take]
    ids[:, :take], score[:, :take] = entry[top], np.take_along_axis(first, top, 1)
    here = np.flatnonzero(own >= 0)
    here = here[~seen[here, own[here]]]
    ids[here, take - 1], score[here, take - 1] = own[here], 1
    seen[here, own[here]] = open_[here, own[here]] = True
    todo = np.isfinite(score)
    hits = open_.copy()
    active = rows
    while len(active):
        best = np.where(todo[active], score[active], -np.inf).argmax(axis=1)
        node = ids[active, best]
        todo[active, best] = False
        open_[active, node] = False
        step = graph[node]
        new = (step >= 0) & ~seen[active[:, None], np.maximum(step, 0)]
        q, slot = np.nonzero(new)
        found = step[q, slot]
        value = np.full(step.shape, -np.inf, np.float32)
        value[q, slot] = np.einsum("ij,ij->i", queries[active[q]], x[found])
        seen[active[q], found] = True
        inside = value[q, slot] >= floor
        open_[active[q][inside], found[inside]] = True
        hits[active[q][inside], found[inside]] = True
        all_ids, all_score = np.concatenate([ids[active], step], axis=1), np.concatenate([score[active], value], axis=1)
        all_todo = np.concatenate([todo[active], new], axis=1)
        top = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
        ids[active], score[active] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_score, top, 1)
        todo[active] = np.take_along_axis(all_todo, top, 1)
        active = active[(todo[active] & np.isfinite(score[active])).any(axis=1)]
    while open_.any():
        q, node = np.nonzero(open_)
        open_[:] = False
        fresh = np.zeros((m, n), bool)
        for lo in range(0, len(q), 1 << 16):
            step = graph[node[lo:lo + (1 << 16)]]
            a, slot = np.nonzero(step >= 0)
            fresh[q[lo:lo + (1 << 16)][a], step[a, slot]] = True
        fresh &= ~seen
        seen |= fresh
        q, node = np.nonzero(fresh)
        for lo in range(0, len(q), 1 << 16):
            a, b = q[lo:lo + (1 << 16)], node[lo:lo + (1 << 16)]
            inside = np.einsum("ij,ij->i", queries[a], x[b]) >= floor
            open_[a[inside], b[inside]] = True
        hits |= open_
    return np.nonzero(hits)


def _spread(nodes: DataFrame, centres: dict, overlap: int) -> DataFrame:
    """Nodes with the numbers of their nearest clusters (0 alone without centres)."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)  # bounded by the sample
    ddl = "node long, label string, dim int, embedding array<double>, times long, clusters array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            label, dim = t.column("label").to_pylist(), t.column("dim").to_pylist()
            vectors, out = t.column("embedding"), [[0]] * len(label)
            keys = list(zip(label, dim, strict=True))
            for key in set(keys) & set(shared.value):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                c = shared.value[key]
                near = np.argsort(-(unit(_matrix(vectors.take(pa.array(at)))) @ c.T), axis=1, kind="stable")[:, :overlap]
                for i, row in zip(at.tolist(), np.sort(near, axis=1).tolist(), strict=True):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in ("node", "label", "dim", "embedding", "times")), pa.array(out, pa.list_(pa.int32()))],
                                             ["node", "label", "dim", "embedding", "times", "clusters"])

    return nodes.select("node", "label", "dim", "embedding", "times").mapInArrow(run, ddl)


def near_links(nodes: DataFrame, centres: dict, threshold: float, overlap: int | None, block: int, degree: int, beam: int) -> DataFrame:
    """nodes (node, label, dim, embedding, times) -> label, dim, node, links
    (rows linked through other nodes), found (those nodes), root (a node linked
    with it, through others maybe). Without an overlap every pair of a label is compared."""
    exact_pass = overlap is None
    spread = _spread(nodes, {} if exact_pass else centres, overlap or 1).withColumn("cluster", F.explode("clusters"))
    sizes = spread.groupBy(*SHARD).agg(F.count("*").alias("size"))
    members = spread.join(sizes, SHARD).withColumn("parts", F.ceil(F.col("size") / block).cast("int"))
    members = written(members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("size"), "graph-members")

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("node").to_numpy()
        g = pruned_graph(unit(_matrix(t.column("embedding"))), degree, 3 * degree, 1.2)
        return pa.table({"node": ids, "near": pa.array([ids[r[r >= 0]].tolist() for r in g], pa.list_(pa.int64()))})

    if exact_pass:
        members = members.withColumn("near", F.array().cast("array<long>"))
    else:
        lists = members.groupBy(*SHARD, "part").applyInArrow(build, "node long, near array<long>")
        lists = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # a list for each of a node's shards
        members = members.join(lists, "node")

    def search(t: pa.Table) -> pa.Table:
        graph_side, query_side = (np.flatnonzero(t.column(c).to_numpy()) for c in ("graph", "query"))
        ids, times = t.column("node").to_numpy(), t.column("times").to_numpy()
        x = unit(_matrix(t.column("embedding")))
        clusters, own = t.column("clusters").to_pylist(), t.column("cluster")[0].as_py()
        label, dim = t.column("label")[0].as_py(), t.column("dim")[0].as_py()

        def table(rows: dict) -> pa.Table:
            n = len(rows)
            links, found, root = zip(*rows.values(), strict=True) if n else ((), (), ())
            return pa.table({"label": pa.array([label] * n, pa.string()), "dim": pa.array([dim] * n, pa.int32()), "node": pa.array(list(rows), pa.int64()),
                             **{c: pa.array(v, pa.int64()) for c, v in (("links", links), ("found", found), ("root", root))}})

        if not len(graph_side) or not len(query_side):
            return table({})
        order = graph_side[np.argsort(ids[graph_side], kind="stable")]
        near = t.column("near").combine_chunks().take(pa.array(order))
        many, flat = np.diff(near.offsets.to_numpy()), near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(ids[order], flat), len(order) - 1)
        here = ids[order][at] == flat
        padded = np.full((len(order), max(1, int(many.max(initial=0)))), -1)
        row = np.repeat(np.arange(len(order)), many)
        slot = np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many)
        padded[row[here], slot[here]] = at[here]
        graph = united(np.zeros((len(order), 0), np.int64), padded)
        a, b = [], []
        position = np.full(len(ids), -1)
        position[order] = np.arange(len(order))
        for lo in range(0, len(query_side), 512):
            some = query_side[lo:lo + 512]
            if exact_pass:
                q, n = np.nonzero(x[some] @ x[order].T >= threshold - 1e-9)
            else:
                q, n = range_search(graph, x[order], x[some], position[some], threshold - 0.02, beam)
            a.append(query_side[lo:lo + 512][q])
            b.append(order[n])
        a, b = np.concatenate(a), np.concatenate(b)
        low, high = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique((low * len(ids) + high)[low != high])
        a, b = pairs // len(ids), pairs % len(ids)
        exact = np.concatenate([np.einsum("ij,ij->i", x[a[lo:lo + 65536]], x[b[lo:lo + 65536]]) for lo in range(0, len(a), 65536)] or [np.zeros(0)]) >= threshold
        a, b = a[exact], b[exact]
        if not len(a):
            return table({})
        width = max(map(len, clusters))
        of = np.array([c + [-1] * (width - len(c)) for c in clusters])
        common = np.full(len(a), np.iinfo(np.int32).max)
        for i in range(width):
            for j in range(width):
                both = (of[a, i] == of[b, j]) & (of[a, i] >= 0)
                common[both] = np.minimum(common[both], of[a[both], i])
        first = common == own
        links = (np.bincount(a[first], times[b[first]], len(ids)) + np.bincount(b[first], times[a[first]], len(ids))).astype(np.int64)
        found = np.bincount(a[first], minlength=len(ids)) + np.bincount(b[first], minlength=len(ids))
        node, root = spanning(ids[a], ids[b])
        rows = {}
        for i in np.flatnonzero(links):
            rows[int(ids[i])] = [int(links[i]), int(found[i]), int(ids[i])]
        for n, r in zip(node.tolist(), root.tolist(), strict=True):
            rows.setdefault(n, [0, 0, n])[2] = r
        return table(rows)

    meet = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    meet = meet.select(*SHARD, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "times", "embedding", "clusters", "near",
                       (F.col("part") <= F.col("other")).alias("graph"), (F.col("part") >= F.col("other")).alias("query"))
    return meet.groupBy(*SHARD, "i", "j").applyInArrow(search, "label string, dim int, node long, links long, found long, root long")


def true_links(nodes: DataFrame, counts: dict, threshold: float, queries: int) -> dict:
    """node -> (label, dim), number of nodes linked with it, by brute force:
    for about ``queries`` nodes by hash, spread over all, and as many more that
    give each label of ``counts`` (label, dim -> nodes) an equal share."""
    base = min(1.0, queries / max(1, nodes.count()))
    rates: dict = {}
    if len(counts) <= queries:
        for (label, _), n in counts.items():
            rates[label] = max(base, rates.get(label, 0.0), min(1.0, queries / (len(counts) * n)))
    rate = F.lit(base)
    if rates:
        rate = F.coalesce(F.create_map(*[F.lit(v) for kv in sorted(rates.items()) for v in kv])[F.col("label")], rate)
    u = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    some = nodes.filter(u < rate).orderBy(u / rate, "node").limit(2 * queries).select("node", "label", "dim", "embedding").collect()
    if not some:
        return {}
    by: dict = {}
    for r in some:
        by.setdefault((r["label"], r["dim"]), []).append(r)
    asked = {k: (np.array([r["node"] for r in v]), unit(np.array([r["embedding"] for r in v], np.float64))) for k, v in by.items()}
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            keys = list(zip(t.column("label").to_pylist(), t.column("dim").to_pylist(), strict=True))
            ids = t.column("node").to_numpy()
            for key in set(keys) & set(shared.value):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                who, q = shared.value[key]
                near = (q @ unit(_matrix(t.column("embedding").take(pa.array(at)))).T >= threshold) & (who[:, None] != ids[at][None, :])
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(near.sum(axis=1))], ["node", "truth"])

    truth = nodes.select("node", "label", "dim", "embedding").mapInArrow(brute, "node long, truth long").groupBy("node").agg(F.sum("truth").alias("truth"))
    key = {r["node"]: (r["label"], r["dim"]) for r in some}
    return {r["node"]: (key[r["node"]], r["truth"]) for r in truth.collect()}  # bounded by the sample


def judge(truth: dict, found: dict, least_recall: float) -> tuple[float, set]:
    """The lowest mean, over strata, of the share of its links that an audited
    node found (1 if no node has links), and the labels that fail. Strata are
    labels, link counts (1 to 3, 4 to 15, 16 to 63, ...) and both; one fails by
    its mean or by its low quantile, and with it the labels of its nodes that
    missed something."""
    strata: dict = {}
    for node, (key, n) in truth.items():
        if n:
            band = (int(n).bit_length() - 1) // 2
            for stratum in ((key, None), (None, band), (key, band)):
                strata.setdefault(stratum, []).append((min(1.0, found.get(node, 0) / n), key))
    lowest, failed = 1.0, set()
    for seen in strata.values():
        shares = sorted(x for x, _ in seen)
        mean = sum(shares) / len(shares)
        lowest = min(lowest, mean)
        if mean < least_recall or shares[int(LOW_SHARE * len(shares))] < LEAST_SHARE:
            failed |= {key for x, key in seen if x < 1}
    return lowest, failed


def _of_labels(keys: set) -> Column:
    """Rows of the given (label, dim)."""
    by: dict = {}
    for label, dim in sorted(keys):
        by.setdefault(dim, []).append(label)
    out = F.lit(False)
    for dim, labels in by.items():
        out = out | ((F.col("dim") == dim) & F.col("label").isin(labels))
    return out


def audited_links(nodes: DataFrame, centres: dict, counts: dict, threshold: float, overlaps: tuple[int, ...], least_recall: float, block: int, degree: int,
                  beam: int, audited: int) -> tuple[DataFrame, float]:
    """``near_links`` of all nodes and their recall. Labels that fail are
    searched again with the next overlap, at last with all pairs of blocks."""
    truth = true_links(nodes, counts, threshold, audited)
    links, todo = None, nodes
    for overlap in (*overlaps, None):
        new = written(near_links(todo, centres, threshold, overlap, block, degree, beam), "graph-links")
        links = new if links is None else links.filter(~_of_labels(failed)).union(new)
        asked = links.filter(F.col("node").isin([n for n, (_, t) in truth.items() if t]))
        recall, failed = judge(truth, {r[0]: r[1] for r in asked.groupBy("node").agg(F.sum("found")).collect()}, least_recall)
        if not failed:
            break
        todo = nodes.filter(_of_labels(failed))
    return links, recall


def graph_dedup(vectors: DataFrame, threshold: float = 0.93, overlaps: tuple[int, ...] = (2, 4, 8), least_recall: float = 0.98, shard_size: int = 512,
                block: int = 1024, degree: int = 16, beam: int = 32, sample: int = 8192, audited: int = 512) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, n_links, component_id,
    kept, recall; one row for each row.

    Vectors of one label and dimension link at a cosine of ``threshold`` or
    more, computed in double precision. A vector that is null, empty, zero or
    holds a null or non-finite number, or whose label or id is null, links
    with nothing: n_links 0, component_id its own id. Equal vectors are found
    exactly. Repeated rows are vectors of their own; ``kept`` says that a row
    has the smallest id of its component. ``recall`` is the audited one, the
    same in all rows: the lowest mean by vector of a label or a range of link
    counts (``judge``). Labels below ``least_recall`` are searched with the next
    overlap, and after the last one exactly, in all pairs of their blocks.
    Extra columns are not read; an empty table gives an empty result.

    The clusters are fitted on at most ``2 * sample`` vectors, the audit reads
    the links of at most ``2 * audited``.
    """
    e = F.col("embedding")
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                       & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), e.cast("array<double>").alias("embedding"), sound.alias("sound"))
    good = rows.filter("sound")
    nodes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("times"))
    nodes = written(nodes.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("embedding")}), "graph-nodes")
    total = nodes.count()
    counts = {(r[0], r[1]): r[2] for r in nodes.groupBy("label", "dim").count().filter(F.col("count") > shard_size).orderBy(F.desc("count"), "label", "dim").limit(sample).collect()}
    some: dict = {}
    if counts:
        u = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
        for r in nodes.filter(u < F.lit(int(min(1.0, sample / total) * (1 << 30)))).orderBy(u, "node").limit(2 * sample).select("label", "dim", "embedding").collect():
            some.setdefault((r[0], r[1]), []).append(r[2])
    centres = centroids({k: np.array(v, np.float64) for k, v in some.items()}, counts, shard_size)
    links, recall = audited_links(nodes, centres, counts, threshold, overlaps, least_recall, block, degree, beam, audited)
    labels = components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("label", "group")
    known = nodes.join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(labels, "node", "left").withColumn("group", F.coalesce("group", "node"))
    known = written(known.drop("dim"), "graph-known")
    smallest = known.groupBy("group").agg(F.min("first").alias("component_id"))
    known = known.join(smallest, "group").select(F.col("label").alias("l"), F.col("embedding").alias("v"),
                                                 (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    out = rows.join(known, F.col("sound") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("v")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(recall).alias("recall"))
