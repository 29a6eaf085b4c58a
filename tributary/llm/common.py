"""Shared helpers: written tables in the cluster's checkpoint folder, word patterns, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A word of the contracts, as a pattern for Spark and for bytes.split().
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark
    context, so that they can import it wherever they run."""
    sc = spark.sparkContext
    if not getattr(sc, "_tributary_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='tributary-ship-')}/tributary-package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(archive)
        sc._tributary_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Unset on a local master (tests): a temporary
    folder; unset on a cluster: an error, since executors share no local disk."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tributary-llm-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def remember(spark: SparkSession, path: str, table: str | None = None) -> None:
    """Note a folder (and catalog table) of this session for ``release``."""
    sc = spark.sparkContext
    if not hasattr(sc, "_tributary_scratch"):
        sc._tributary_scratch = []
    sc._tributary_scratch.append((path, table))


def release(spark: SparkSession) -> int:
    """Delete all folders and catalog tables that this session's operators have
    written on their way. Call it when their results have been stored: frames
    that were not yet computed can't be read after. Returns how many there were."""
    scratch = getattr(spark.sparkContext, "_tributary_scratch", [])
    n = len(scratch)
    while scratch:
        path, table = scratch.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    remember(spark, path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def again(df: DataFrame) -> DataFrame:
    """The table of a frame of ``written`` as a frame of its own, for joins with itself."""
    return df.sparkSession.read.schema(df.schema).parquet(df._written_path)


def drop_written(df: DataFrame) -> None:
    """Delete the folder behind a frame of ``written`` that nothing reads any more."""
    spark, path = df.sparkSession, getattr(df, "_written_path", None)
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[[tuple], tuple]], ddl: str, schema: pa.Schema,
             slice_rows: int = 1024) -> DataFrame:
    """One output row for each input row, in Arrow batches. ``make`` runs once
    in a task and returns the row function; a batch is cut into slices, so the
    Python objects alive at a time stay few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for at in range(0, b.num_rows, slice_rows):
                part = b.slice(at, slice_rows)
                cols = [part.column(i).to_pylist() for i in range(part.num_columns)]
                yield rows_to_batch([f(row) for row in zip(*cols, strict=True)], schema)

    return df.mapInArrow(run, ddl)
