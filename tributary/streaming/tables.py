"""Tables that are published as a whole, and views that outlive a session.

A write puts its files into a folder of its own (``version=n``) and then, as
its last step, a small manifest that says which versions hold which partitions.
Readers open the newest manifest: a write that fails before that step changes
nothing, and a reader keeps the files it has opened while new versions are
published. Replacing partitions writes only these; the manifest points to the
older versions for the others. Of two writers that start from one manifest the
second fails and may try again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from ..plans.session import delete_path, save_partitioned

MANIFESTS = "_manifests"
VERSION = "version"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative folders of the partitions under ``path``."""
    if not depth:
        return [""]
    found = [n for n in _names(spark, path) if "=" in n]
    return [n if not rest else f"{n}/{rest}" for n in found for rest in _partitions(spark, f"{path}/{n}", depth - 1)]


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest published manifest."""
    names = [n for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]
    if not names:
        return None
    return json.loads(spark.read.text(f"{path}/{MANIFESTS}/{names[-1]}", wholetext=True).first()[0])


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Write beside, then rename: readers see all of a manifest or none of it."""
    fs, final = _fs(spark, f"{path}/{MANIFESTS}/{manifest['number']:010d}.json")
    _, beside = _fs(spark, f"{path}/{MANIFESTS}/.{manifest['version']}")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(beside, final):
        fs.delete(beside, False)
        raise RuntimeError(f"{path}: another writer has published version {manifest['number']}; try again")


def table_exists(spark: SparkSession, path: str) -> bool:
    return _manifest(spark, path) is not None


def _write(df: DataFrame, path: str, partition_by: list[str], fmt: str, old: dict | None) -> dict:
    """The files of a new version, and a manifest of them alone."""
    import uuid

    spark, number = df.sparkSession, (old["number"] if old else 0) + 1
    version = f"{number}-{uuid.uuid4().hex[:12]}"
    folder = f"{path}/{VERSION}={version}"
    if partition_by:
        save_partitioned(df, folder, partition_by, fmt)
    else:
        df.write.format(fmt).save(folder)
    return {"number": number, "version": version, "format": fmt, "partition_by": partition_by, "schema": df.schema.json(),
            "parts": {p: [version] for p in _partitions(spark, folder, len(partition_by))}}


def write_audited(df: DataFrame, path: str, metrics: list, audit: Callable[[dict], list[str]], partition_by: list[str] | None = None,
                  fmt: str = "parquet") -> dict:
    """Write, audit, publish: the aggregates ``metrics`` are taken from the rows
    while they are written, in the same job; ``audit`` gets them by name and
    names what is wrong. With nothing wrong the version is published; else its
    files go, readers keep the version before, and ``AuditError`` is raised.
    Returns the metrics."""
    spark, seen = df.sparkSession, Observation()
    new = _write(df.observe(seen, *metrics), path, list(partition_by or []), fmt, _manifest(spark, path))
    wrong = audit(seen.get)
    if wrong:
        delete_path(spark, f"{path}/{VERSION}={new['version']}")
        raise AuditError(f"{path}: not published: {', '.join(wrong)}", seen.get)
    _publish(spark, path, new)
    return seen.get


class AuditError(ValueError):
    """A table that was not published; ``metrics`` says what its rows held."""

    def __init__(self, message: str, metrics: dict):
        super().__init__(message)
        self.metrics = metrics


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Full-refresh materialisation (CREATE OR REPLACE TABLE AS), published at
    once; ``mode="append"`` adds to what is there."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    spark = df.sparkSession
    old = _manifest(spark, path)
    new = _write(df, path, list(partition_by or []), fmt, old)
    if old and mode == "append":
        if old["partition_by"] != new["partition_by"]:
            raise ValueError(f"the table is partitioned by {old['partition_by']}")
        new["schema"] = old["schema"]
        new["parts"] = {p: old["parts"].get(p, []) + new["parts"].get(p, []) for p in {**old["parts"], **new["parts"]}}
    _publish(spark, path, new)


def write_incremental(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet", values: list | None = None) -> None:
    """Replace the partitions present in ``df``; others are left untouched.
    With ``values`` exactly these are replaced: rows of others are not written,
    and a partition of the list without rows goes. ``df`` is computed once,
    and may read the table itself."""
    from pyspark.sql import functions as F

    spark = df.sparkSession
    if values is not None:
        df = df.where(F.col(partition_col).cast("string").isin(*map(str, values)))
    old = _manifest(spark, path)
    new = _write(df, path, [partition_col], fmt, old)
    if old:
        if old["partition_by"] != [partition_col]:
            raise ValueError(f"the table is partitioned by {old['partition_by']}")
        gone = {f"{partition_col}={v}" for v in values or []}
        new["parts"] = {p: v for p, v in old["parts"].items() if p not in gone} | new["parts"]
    _publish(spark, path, new)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as last published. Filters on partition columns prune folders."""
    m = _manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    folders = sorted(f"{path}/{VERSION}={v}" + (f"/{p}" if p else "") for p, versions in m["parts"].items() for v in versions)
    if not folders:
        return spark.createDataFrame([], schema)
    whole = T.StructType([f for f in schema if f.name not in m["partition_by"]] + [schema[c] for c in m["partition_by"]] + [T.StructField(VERSION, T.StringType())])
    df = spark.read.format(m["format"]).schema(whole).option("basePath", path).load(folders)
    return df.select(*schema.fieldNames())


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete the versions that the newest manifest does not use, and the older
    manifests. Readers of older versions must be done."""
    m = _manifest(spark, path)
    if m:
        used = {f"{VERSION}={v}" for versions in m["parts"].values() for v in versions}
        for n in _names(spark, path):
            if n.startswith(f"{VERSION}=") and n not in used:
                delete_path(spark, f"{path}/{n}")
        for n in _names(spark, f"{path}/{MANIFESTS}")[:-1]:
            delete_path(spark, f"{path}/{MANIFESTS}/{n}")


# ---- views ---------------------------------------------------------------------

def register_view(spark: SparkSession, folder: str, name: str, sql: str, inputs: dict[str, str]) -> DataFrame:
    """A view kept under ``folder``: its query and the tables that the query
    names (name -> path of a published table, or of another view as
    ``view:name``). Nothing is computed; every session that opens it sees the
    tables as they are then."""
    fs, p = _fs(spark, f"{folder}/{name}.json")
    df = _query(spark, folder, sql, inputs)  # a query that does not resolve is not registered
    out = fs.create(p, True)
    out.write(bytearray(json.dumps({"sql": sql, "inputs": inputs}).encode()))
    out.close()
    return df


def open_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    v = json.loads(spark.read.text(f"{folder}/{name}.json", wholetext=True).first()[0])
    return _query(spark, folder, v["sql"], v["inputs"])


def _query(spark: SparkSession, folder: str, sql: str, inputs: dict[str, str]) -> DataFrame:
    frames = {n: open_view(spark, folder, p[5:]) if p.startswith("view:") else read_table(spark, p) for n, p in inputs.items()}
    return spark.sql(sql.format(**{n: "{" + n + "}" for n in frames}), **frames)
