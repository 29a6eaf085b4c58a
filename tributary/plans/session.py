"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for this workload on any cluster size.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.ui.enabled": "false",
}
# Local / small-data runs: let AQE coalesce tiny shuffles, but not below a
# size that would leave cores idle (on a cluster the advisory size governs).
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


def build_session(master: str | None = None, app: str = "tributary", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass ``master=None``
    and let the submit configuration decide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Where it is unset, a local master (one machine)
    gets a temporary folder; a cluster gets an error, because its executors
    share no local disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="tributary-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: computed once,
    lineage cut, safe when executors are lost."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Files that a task of ``save_partitioned`` holds open, and the bytes each of them buffers at most.
OPEN_FILES, FILE_BUFFER = 32, 16 << 20


def save_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Save ``df`` in folders by the columns ``by``. A task keeps a file open for
    each of its first ``OPEN_FILES`` folders instead of sorting all its rows by
    them, so that its memory does not grow with its rows; only rows of further
    folders are sorted."""
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, None)
    conf.set(name, str(OPEN_FILES))
    try:
        df.write.partitionBy(*by).format(fmt).option("parquet.block.size", FILE_BUFFER).save(path)
    finally:
        conf.set(name, before) if before is not None else conf.unset(name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system API (any store)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
