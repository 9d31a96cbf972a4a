"""Readers for label list files (CSV, text logs, JSON lists, label dumps).

All readers return DataFrames of strings plus a ``row_no`` that follows file
order (file index × 2^33 + position), which the "keep first row" rules need.
Spark keeps the row order of a single file split; multi-file reads are
ordered by the sorted path list given here.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("address", "is_scam", "description")
FILE_STRIDE = 1 << 33


def _with_row_no(df: DataFrame, file_index: int = 0) -> DataFrame:
    # monotonically_increasing_id = partition index << 33 | position: file order for one file.
    return df.withColumn("row_no", F.lit(file_index * FILE_STRIDE * 1024) + F.monotonically_increasing_id())


def read_csv_strings(spark: SparkSession, path: str, skip_first_line: bool = False,
                     strip_header_quotes: bool = False, file_index: int = 0) -> DataFrame:
    """Header CSV with every column as string (no inference).

    ``skip_first_line``: the file starts with a note line before the header
    (single file).  Only the header line goes to the driver; rows are parsed
    JVM-side with ``from_csv``.
    """
    if not skip_first_line:
        df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    else:
        import csv as _csv
        lines = spark.read.text(path).withColumn("_i", F.monotonically_increasing_id())
        header_line = lines.where(F.col("_i") == 1).first()["value"]
        names = next(_csv.reader([header_line]))
        schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
        parsed = lines.where(F.col("_i") > 1).select(F.from_csv("value", schema).alias("r"), "_i")
        df = parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])
    if strip_header_quotes:
        df = df.toDF(*[c.strip('"') for c in df.columns])
    return _with_row_no(df, file_index)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of objects (one document per file)."""
    return _with_row_no(spark.read.option("multiLine", True).json(path))


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    if schema:
        r = r.schema(schema)
    return _with_row_no(r.json(path))


DUMP_SCHEMA = "map<string, struct<name: string, labels: array<string>>>"


def read_label_dump(spark: SparkSession, path: str) -> DataFrame:
    """``{address: {name, labels[]}}`` documents → (address, name, labels, row_no).

    A single JSON object cannot be split, so each file is parsed by one task;
    large dumps should be landed as JSON lines and read with ``read_json_lines``.
    """
    doc = spark.read.option("wholetext", True).text(path)
    m = doc.select(F.posexplode(F.from_json("value", DUMP_SCHEMA)).alias("row_no", "address", "v"))
    return m.select("address", F.col("v.name").alias("name"), F.col("v.labels").alias("labels"),
                    F.col("row_no").cast("bigint").alias("row_no"))


def list_label_csvs(root: str, spark: SparkSession | None = None) -> list:
    """Every ``processed/*.csv`` below ``root``, sorted (the merge's source order).

    With a session the listing goes through the Hadoop filesystem of ``root``
    (works on any cluster store); without one it uses the local filesystem.
    """
    if spark is None:
        return sorted(glob.glob(os.path.join(root, "**", "processed", "*.csv"), recursive=True))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(path, True)
    out = []
    while it.hasNext():
        p = it.next().getPath()
        name, parent = p.getName(), p.getParent().getName()
        if parent == "processed" and name.endswith(".csv"):
            out.append(p.toString())
    return sorted(out)


def read_label_dir(spark: SparkSession, paths, order_col: str | None = None, skipped: list | None = None) -> list:
    """Readable label CSVs that have the required columns, in the given order.

    Files without a header or lacking a required column are skipped, and named in
    ``skipped`` if a list is given; any other error (storage, permissions) is raised.  The
    check reads only each file's header.  ``order_col`` names a column that holds the row
    order inside a file (else the read order is used).
    """
    out = []
    for i, p in enumerate(paths):
        df = spark.read.option("header", True).option("inferSchema", False).csv(p)
        cols = set(df.columns)
        if not set(REQUIRED).issubset(cols):
            if skipped is not None:
                skipped.append(p)
            continue
        if order_col and order_col in cols:
            out.append(df.select(*REQUIRED, F.col(order_col).cast("bigint").alias("row_no")))
        else:
            out.append(_with_row_no(df.select(*REQUIRED), i))
    return out
