"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopweave.session import checkpoint_dir
from hopweave.sources.tables import table

__all__ = ["stage", "table", "crc_bucket", "source_bytes", "pieces_for"]


def stage(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table beside the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors and keeps column pruning; every call
    takes a folder of its own, removed when the driver ends.  Shuffle files of finished
    jobs stay until the driver collects garbage: ``release`` asks for that after a large
    shuffle whose result is now a table.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def source_bytes(df: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(rows, text bytes) of a table: two numbers that size the partitioning."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text_col))).alias("b")).first()
    return int(r["n"] or 0), int(r["b"] or 0)


def pieces_for(total: int, each: int, least: int = 1) -> int:
    """How many pieces of about ``each`` units hold ``total`` units."""
    return max(least, -(-int(total) // int(each)))
