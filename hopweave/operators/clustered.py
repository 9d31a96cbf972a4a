"""Stage tables clustered by a key: bucketed and sorted once, joined and windowed without a shuffle.

A stage that several later steps join or window by address is stored as a table of the session
catalog with a fixed number of buckets per key.  Two tables with equal keys and bucket counts
join bucket by bucket, and windows and aggregates by the key (or by the key and more) run inside
a bucket.  The rows are dealt to the buckets before writing, so a bucket is one file per table
(and per partition, if it is partitioned) however many tasks the input had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hopweave.session import stage_path

#: Rows of a bucket, for tables whose rows are counted by the caller.
ROWS_A_BUCKET = 5_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """A power of two, so that tables of different sizes can still be read together."""
    n = least
    while n * ROWS_A_BUCKET < rows:
        n *= 2
    return n


def write_clustered(df: DataFrame, table: str, keys: list[str], buckets: int, sort: list[str] | None = None,
                    partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Store ``df`` as catalog table ``table``, bucketed by ``keys`` and sorted by ``sort`` within
    a bucket (the keys by default); returns the stored table.

    ``path``: where the files go (a folder beside the checkpoint folder by default).  An existing
    table of that name is replaced.  Null keys share a bucket.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    dealt = df.repartition(buckets, *keys)
    w = dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*(sort or keys)).option("path", path or stage_path(spark, table))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)
    return spark.table(table)


def drop_clustered(spark: SparkSession, table: str) -> None:
    """Forget a clustered table (its files go with their folder)."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
