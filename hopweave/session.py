"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC calendar semantics, adaptive execution with
# skew-join splitting, runtime bloom filters for the big ledger joins and the
# partial per-group limit that keeps top-k windows bounded before the shuffle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small one-row-per-account tables are expanded into one row per account-day:
    # let adaptive coalescing keep about one partition per core for them instead
    # of folding them into a single 1 MB partition (parallelism first).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Tables keyed by (address, day) that are hash-partitioned by address join and
    # window on address without a further shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hopweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Session-level settings also apply when the session already existed.
    for k, v in conf.items():
        if not k.startswith("spark.ui"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a fresh folder (tests, a laptop); on a cluster a
    machine-local folder would be lost, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors need a shared folder")
        current = tempfile.mkdtemp(prefix="hopweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table beside the shared checkpoint folder.

    Every call takes a folder of its own (runs and sessions never meet), removed when the
    driver ends.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex}"
    hadoop_fs(spark, path).deleteOnExit(hadoop_path(spark, path))
    return path


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def hadoop_fs(spark: SparkSession, path: str):
    """The file system of a path, wherever it is."""
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return hadoop_fs(spark, path).exists(hadoop_path(spark, path))


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_fs(spark, path).delete(hadoop_path(spark, path), True)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    if not hadoop_fs(spark, src).rename(hadoop_path(spark, src), hadoop_path(spark, dst)):
        raise OSError(f"cannot rename {src} to {dst}")


@contextmanager
def setting(spark: SparkSession, key: str, value):
    """A session setting for the jobs run inside the block (None: as it is)."""
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if value is not None:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` as a written table beside the shared checkpoint folder, partitioned by columns:
    its lineage is cut, and reads keep column and partition pruning."""
    path = stage_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
