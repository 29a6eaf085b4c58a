"""Mixing sources to target weights with hash-threshold histograms.

Words are summed by source and bucket of a document hash; within each source
the bucket in which the budget falls is found, and only that bucket is refined
by the next bits, until the threshold has all its bits. Documents are then
filtered by comparing their hash with their source's threshold; nothing is
sorted. The hash is that of id and text, so that only identical rows share it;
where several stand at a threshold, bits of their row numbers tell them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD, written

BITS, LEVELS, TIE_LEVELS = 12, 3, 2
TIE_BITS = BITS * TIE_LEVELS


def sizes(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size in words, and a key: 36 bits of the MD5 of id and
    text, then 24 bits of the row's number."""
    whole = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
    key = F.conv(F.substring(F.md5(whole), 1, BITS * LEVELS // 4), 16, 10).cast("long")
    row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << TIE_BITS))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(
        F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), (F.shiftleft(key, TIE_BITS) + row).alias("key"),
        *([F.struct(*carry).alias("carried")] if carry else []))


def targets(items: DataFrame, most: int = 3) -> DataFrame:
    """source, source_size, target, repeats (whole passes), rest (words of a partial pass).

    With sources in the order of size * most / weight, capping the first j
    leaves level_j = what is left / weight left for the others; it rises while
    the next source is still below it and falls afterwards, so the level of
    the mix is the largest of them. One row for each source.
    """
    by = items.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.col("weight")
    by = by.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    before = Window.orderBy(most * F.col("source_size").cast("double") / w, F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    by = by.withColumns({"capped": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most,
                         "weighed": F.coalesce(F.sum("weight").over(before), F.lit(0)),
                         "total": F.sum("source_size").over(everything), "weights": F.sum("weight").over(everything)})
    by = by.withColumn("level", (F.col("total") - F.col("capped")).cast("double") / (F.col("weights") - F.col("weighed")).cast("double"))
    by = by.withColumn("level", F.max("level").over(everything))
    target = F.least((most * F.col("source_size")).cast("double"), w * F.col("level"))
    by = by.select("source", "source_size", target.alias("target"))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return by.withColumn("repeats", F.least(F.lit(most), repeats).cast("long")).withColumn(
        "rest", F.when(F.col("repeats") < most, F.col("target") - F.col("repeats") * F.col("source_size")).otherwise(0.0))


def thresholds(items: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with ``threshold`` (documents with a smaller key are in the
    partial pass), ``edge`` (so are those with this very key, when that comes
    nearer) and ``shift`` (bits that a key loses before it is compared: those of
    row numbers, unless several rows share a threshold)."""
    state = goals.withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
    for level in range(LEVELS + TIE_LEVELS):
        shift = BITS * (LEVELS + TIE_LEVELS - 1 - level)
        now = F.shiftright("key", shift)
        inside = items.alias("i").join(state.select("source", "prefix").alias("s"), F.expr("i.source <=> s.source")).filter(
            F.shiftright("key", shift + BITS) == F.col("prefix")) if level else items.alias("i")
        hist = inside.groupBy(F.col("i.source").alias("source"), now.alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        g = state.select(F.col("source").alias("of"), "rest", "below")
        hist = hist.join(g, F.expr("source <=> of"))
        here = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows at most
        hist = hist.withColumn("upto", F.col("below") + F.coalesce(F.sum("words").over(here), F.lit(0)))
        edge = hist.filter(F.col("upto") <= F.col("rest")).groupBy("source").agg(
            F.max(F.struct("bucket", "upto", "words", "rows")).alias("e")).select(F.col("source").alias("of"), F.col("e.bucket").alias("prefix"),
                                                                                 F.col("e.upto").alias("below"), F.col("e.words").alias("words"), F.col("e.rows").alias("rows"))
        state = written(goals.join(edge, F.expr("source <=> of")).drop("of"), f"mix-edge{level}")
        if level == LEVELS - 1 and not state.filter("rows > 1").limit(1).count():
            break
    near = F.abs(F.col("below") + F.col("words") - F.col("rest")) < F.abs(F.col("below") - F.col("rest"))
    return state.select("source", "source_size", "target", "repeats", F.col("prefix").alias("threshold"), near.alias("edge"), F.lit(shift).alias("shift"))


def mix(docs: DataFrame, most: int = 3) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, size, source_size, target, taken.

    Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and
    share all words; a source's target stops at ``most`` times its size and
    the rest is shared anew by weight. ``taken`` is a whole multiple of the
    document's size, at most ``most`` times. A null text has size 0, a null
    source is a source of its own. Null and repeated ids are told apart by their
    texts, and of identical rows as many are taken as come nearest to the
    target (which ones makes no difference), so reruns agree. Extra columns are
    not read; an empty table gives an empty result.

    The slim sizes are written once. What joins back is one row for each
    source, read from a written table: Spark broadcasts it by its file size.
    """
    items = written(sizes(docs), "mix-sizes")
    return _taken(items, _cut(items, most)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_rows(docs: DataFrame, most: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """The mix itself: ``carried`` (a struct of the columns named in
    ``carry``), as often as the mix takes the document. A document without
    words goes by the same rule. Sizes are computed anew while the texts pass,
    so they are neither shuffled nor joined by id."""
    cut = _cut(written(sizes(docs), "mix-sizes"), most)
    return _taken(sizes(docs, carry), cut).filter("times > 0").select("carried", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("carried")


def _cut(items: DataFrame, most: int) -> DataFrame:
    return thresholds(items, written(targets(items, most), "mix-targets"))


def _taken(items: DataFrame, cut: DataFrame) -> DataFrame:
    key = F.expr("shiftright(key, shift)")
    part = (key < F.col("threshold")) | (F.col("edge") & (key == F.col("threshold")))
    return items.alias("i").join(cut.alias("c"), F.expr("i.source <=> c.source")).withColumn("times", F.col("repeats") + part.cast("long"))
