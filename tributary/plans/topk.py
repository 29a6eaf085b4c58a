"""Grouping by long strings, and the first groups, without shuffling the strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_fingerprint(rows: DataFrame, string: Column, aggs: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_fp``, a 128-bit fingerprint of their string, and their groups by it."""
    keyed = rows.withColumn("_fp", F.unhex(F.md5(string)))
    return keyed, keyed.groupBy("_fp").agg(*aggs)


def first_groups(keyed: DataFrame, groups: DataFrame, string: Column, name: str, count: str, top: int | None) -> DataFrame:
    """The ``top`` groups by ``count`` down and string up (all without ``top``),
    with their string as ``name``. The count of the last of the first ``top`` is
    found from fingerprints and counts alone; strings are made for the groups
    that reach it only, the tied ones included, and decide among these. Hand in
    stored ``groups``: they are read three times."""
    chosen = groups
    if top:
        edge = groups.orderBy(F.col(count).desc()).limit(top).agg(F.min(count)).scalar()
        chosen = groups.where(F.col(count) >= edge)
    strings = keyed.join(chosen.select("_fp"), "_fp", "left_semi").groupBy("_fp").agg(F.min(string).alias(name))
    out = chosen.join(strings, "_fp").drop("_fp").orderBy(F.col(count).desc(), F.col(name))
    return out.limit(top) if top else out


def keep(store: Callable[[DataFrame], DataFrame] | None) -> Callable[[DataFrame], DataFrame]:
    return store or (lambda df: df)
