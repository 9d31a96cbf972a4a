"""Publishing: compaction into capped zstd parts, validated repack, checksum manifest, verify.

Scale notes: files are hashed in chunks, one task per file (never a whole file in a row), so
their size does not matter; sizes and paths come from the file system's listing.
"""

from __future__ import annotations

import hashlib
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopweave.session import delete_path, hadoop_fs, hadoop_path, path_exists, rename_path

DEFAULT_ROWS_PER_FILE = 40_000_000


def _parts(spark: SparkSession, src) -> list:
    return [src] if isinstance(src, str) else list(src)


def _part_schemas(spark: SparkSession, src) -> dict:
    """Schema of every Parquet file below the given paths (footers only)."""
    out = {}
    for p in _parts(spark, src):
        for f in sorted(spark.read.parquet(p).inputFiles()):
            out[f] = spark.read.parquet(f).schema
    return out


def pub_compact(spark: SparkSession, src, dst: str, rows_per_file: int = DEFAULT_ROWS_PER_FILE,
                unify_schema: bool = False, row_group_bytes: int | None = None) -> DataFrame:
    """Many parquet parts → parts of at most ``rows_per_file`` rows, zstd.

    Without ``unify_schema`` all parts must have the same columns and types, else this
    raises.  With it, the result has the first part's columns and types and then the
    columns it lacks, in the order they appear; other types are cast, missing columns are
    NULL.
    """
    schemas = _part_schemas(spark, src)
    first = next(iter(schemas.values()))
    plain = lambda s: [(f.name, f.dataType) for f in s.fields]
    if all(plain(s) == plain(first) for s in schemas.values()):
        df = spark.read.schema(first).parquet(*_parts(spark, src))
    elif not unify_schema:
        other = next(f for f, s in schemas.items() if plain(s) != plain(first))
        raise ValueError(f"parts have different schemas: {next(iter(schemas))} and {other}")
    else:
        want = {}
        for s in schemas.values():
            for f in s.fields:
                want.setdefault(f.name, f.dataType)
        same = {}
        for path, s in schemas.items():
            same.setdefault(tuple((f.name, f.dataType.json()) for f in s.fields), (s, []))[1].append(path)
        df = None
        for s, paths in same.values():
            part = spark.read.schema(s).parquet(*paths)
            cols = [F.col(f"`{c}`").cast(t).alias(c) if c in s.names else F.lit(None).cast(t).alias(c) for c, t in want.items()]
            df = part.select(*cols) if df is None else df.unionByName(part.select(*cols))
    w = df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    w.parquet(dst)
    return spark.read.parquet(dst)


def pub_repack_validated(spark: SparkSession, src: str, staging: str, final: str) -> DataFrame:
    """Rewrite to zstd in a staging folder, compare row counts, publish only on a match.

    What is published is the validated folder itself, renamed; the version before it is
    moved aside first and removed last.  Returns one row: rows_in, rows_out, published.
    """
    df = spark.read.parquet(src)
    df.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    n_in = df.count()
    n_out = spark.read.parquet(staging).count()
    ok = n_in == n_out
    if ok:
        old = f"{final.rstrip('/')}__{uuid.uuid4().hex}"
        had = path_exists(spark, final)
        if had:
            rename_path(spark, final, old)
        rename_path(spark, staging, final)
        if had:
            delete_path(spark, old)
    return spark.createDataFrame([(n_in, n_out, ok)], "rows_in bigint, rows_out bigint, published boolean")


# Fixed value: endings of files that are not published.
SKIP_ENDINGS = (".tmp", ".part")
CHUNK = 8 << 20


def list_files(spark: SparkSession, root: str) -> list:
    """(relative path, full path, size, mtime) of all published files below ``root``: names
    that do not begin with a dot and do not end in .tmp or .part."""
    fs, base = hadoop_fs(spark, root), hadoop_path(spark, root)
    top = fs.getFileStatus(base).getPath().toString().rstrip("/") + "/"
    it, out = fs.listFiles(base, True), []
    while it.hasNext():
        f = it.next()
        path = f.getPath().toString()
        rel = path[len(top):]
        name = rel.rsplit("/", 1)[-1]
        if not any(x.startswith(".") for x in rel.split("/")) and not name.endswith(SKIP_ENDINGS):
            out.append((rel, path, f.getLen(), f.getModificationTime()))
    return sorted(out)


def checksum_rows(rows: DataFrame, content_col: str, keep) -> DataFrame:
    """``keep`` plus size, sha256 and md5 of a text column's bytes (the manifest's measures)."""
    c = F.col(content_col).cast("binary")
    return rows.select(*keep, F.octet_length(c).cast("bigint").alias("size"), F.sha2(c, 256).alias("sha256"), F.md5(c).alias("md5"))


def pub_manifest(spark: SparkSession, root: str, with_md5: bool = True) -> DataFrame:
    """path (relative to ``root``), size, mtime (epoch ms), sha256[, md5] of every published file.

    Files are read by Spark in records of ``CHUNK`` bytes, in order, by one task per file.
    """
    files = spark.createDataFrame(list_files(spark, root) or [], "path string, full string, size bigint, mtime bigint")
    files = files.repartition(max(1, min(len(files.take(10_000)), 10_000)), "path")

    def hashed(batches):
        from pyarrow import fs as arrow_fs
        for b in batches:
            sha, md5 = [], []
            for full in b.column("full").to_pylist():
                system, path = arrow_fs.FileSystem.from_uri(full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file:///") else full)
                a, m = hashlib.sha256(), hashlib.md5()
                with system.open_input_stream(path) as f:
                    while chunk := f.read(CHUNK):
                        a.update(chunk)
                        m.update(chunk)
                sha.append(a.hexdigest())
                md5.append(m.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("size"), b.column("mtime"), pa.array(sha, pa.string()), pa.array(md5, pa.string())],
                                             names=["path", "size", "mtime", "sha256", "md5"])

    out = files.mapInArrow(hashed, "path string, size bigint, mtime bigint, sha256 string, md5 string")
    return out if with_md5 else out.drop("md5")


def append_manifest(manifest: DataFrame, path: str, run: str | None = None) -> None:
    """Append a manifest to its history, one JSON line per file, marked with the run."""
    manifest.withColumn("run", F.lit(run or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))).write.mode("append").json(path)


def write_label_csv(labels: DataFrame, path: str) -> None:
    """The merged label list as CSV with a header (a folder of part files)."""
    labels.write.mode("overwrite").option("header", True).csv(path)


def pub_verify(listed: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare a stored manifest with a recomputed one: ok / mismatch / missing / not listed."""
    l = listed.select("path", F.col("sha256").alias("want"))
    a = actual.select("path", F.col("sha256").alias("got"))
    j = l.join(a, "path", "full_outer")
    status = (F.when(F.col("want").isNull(), "not listed").when(F.col("got").isNull(), "missing")
              .when(F.col("want") == F.col("got"), "ok").otherwise("mismatch"))
    return j.select("path", status.alias("status")).orderBy("path")
