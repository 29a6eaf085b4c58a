"""An export of one table for each day, whose schema changes over time.

Day tables are folders ``events_YYYYMMDD``. Only those of the scan's dates are
opened: the names are listed, not the files below them, so days out of range
(and intraday tables) cost nothing and may hold anything. Days of one schema
are read together, each kind with its own schema, and flattened on their own:
a struct or field that a kind lacks is NULL there, types are cast to those of
the flat events, and column pruning works on what is really in the files. What
the source mode needs must be in some day of the scan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AttributionConfig
from .events import flatten_events

SHARD = re.compile(r"^events_(\d{8})$")


def shards(spark: SparkSession, root: str, first: str, last: str) -> dict[str, str]:
    """Day -> folder of the day tables from ``first`` to ``last``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [SHARD.match(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory()]
    return {m[1]: f"{root.rstrip('/')}/{m[0]}" for m in sorted((m for m in found if m), key=lambda m: m[1]) if first <= m[1] <= last}


def merged(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that has the fields of both; where types differ, the first one's
    (flattening casts each by itself)."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f for f in b}
        own = [T.StructField(f.name, merged(f.dataType, theirs[f.name].dataType) if f.name in theirs else f.dataType) for f in a]
        return T.StructType(own + [f for f in b if f.name not in a.fieldNames()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged(a.elementType, b.elementType))
    return a


def schema_groups(spark: SparkSession, folders: list[str], fmt: str) -> list[tuple[T.StructType, list[str]]]:
    """Folders by schema, in order of their first day. The schema of a folder
    comes from one of its files."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for f in folders:
        schema = spark.read.format(fmt).load(f).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(f)
    return list(groups.values())


def read_sharded_events(spark: SparkSession, root: str, cfg: AttributionConfig, fmt: str = "parquet") -> DataFrame:
    """Flat events of the day tables in [scan_start, end_date]."""
    days = shards(spark, root, cfg.scan_start_date, cfg.end_date)
    if not days:
        raise FileNotFoundError(f"no day table events_YYYYMMDD from {cfg.scan_start_date} to {cfg.end_date} under {root}")
    groups = schema_groups(spark, list(days.values()), fmt)
    whole = reduce(merged, [s for s, _ in groups])
    parts = []
    for schema, folders in groups:
        df = spark.read.format(fmt).schema(schema).load(folders)
        if "event_date" not in schema.fieldNames():
            df = df.withColumn("event_date", F.regexp_extract(F.col("_metadata.file_path"), r"events_(\d{8})/", 1))
        parts.append(flatten_events(df, cfg, whole))
    return reduce(DataFrame.unionByName, parts)
