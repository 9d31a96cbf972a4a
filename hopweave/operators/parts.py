"""Tables of part folders (``key=value``) that survive a stop at any point.

Parts are written below a hidden folder of the table.  Then one commit file names the files and
the row count of each, and only then the parts take their places, one rename a part; a part
that is replaced waits in ``.old`` until then.  A part counts when its files are exactly
those that a commit names.  What a stop can leave is therefore: a hidden folder (ignored, deleted
by the next writer), a part with other files than its commit (not read, and written anew),
or a part in ``.old`` whose successor did not arrive (read in its place, and put back by the
next writer).  Writers of one table must not run at the same time.

The driver handles a name per part and file: parts are a calendar's windows or hash shards.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.session import delete_path, hadoop_fs, hadoop_path, path_exists, rename_path, setting

COMMITS = ".commits"
OLD = ".old"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def _children(spark: SparkSession, folder: str) -> list[str]:
    if not path_exists(spark, folder):
        return []
    return [s.getPath().getName() for s in hadoop_fs(spark, folder).listStatus(hadoop_path(spark, folder))]


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    return sorted(n for n in _children(spark, folder) if not n.startswith(("_", ".")))


def commits(spark: SparkSession, path: str) -> dict[str, list[dict]]:
    """Per part the files and rows that the table's commits name (a replaced part has two)."""
    for name in sorted(_data_files(spark, f"{path.rstrip('/')}/{COMMITS}"), reverse=True):
        stream = hadoop_fs(spark, path).open(hadoop_path(spark, f"{path.rstrip('/')}/{COMMITS}/{name}"))
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)
    return {}


def commit(spark: SparkSession, path: str, said: dict[str, list[dict]]) -> None:
    """Put a new commit file in place, then drop the earlier ones."""
    folder = f"{path.rstrip('/')}/{COMMITS}"
    before = _data_files(spark, folder)
    name = f"{int(before[-1].split('.')[0]) + 1 if before else 0:012d}.json"
    out = hadoop_fs(spark, folder).create(hadoop_path(spark, f"{folder}/_{name}"), True)
    out.write(bytearray(json.dumps(said).encode()))
    out.close()
    rename_path(spark, f"{folder}/_{name}", f"{folder}/{name}")
    for old in before:
        delete_path(spark, f"{folder}/{old}")


def entry(spark: SparkSession, said: dict[str, list[dict]], path: str, name: str) -> dict | None:
    """What a commit says of a part that is whole; None for any other folder."""
    if name not in said:
        return None
    files = _data_files(spark, f"{path}/{name}")
    return next((e for e in said[name] if e["files"] == files), None)


def _named(names: list[str], key: str) -> list[str]:
    return [n for n in names if n.startswith(f"{key}=")]


#: Parts that a task writes side by side, without sorting, when its rows came dealt.
OPEN_PARTS = 64


def stage_parts(df: DataFrame, path: str, key: str, dealt: bool = False, **options) -> str:
    """Write ``df`` as part folders below a hidden folder of the table and commit them; returns
    the folder.

    ``dealt``: the caller has dealt the rows so that a task has few parts; they are not shuffled again."""
    spark, path = df.sparkSession, path.rstrip("/")
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    # rebalance splits a large part over several tasks and files
    writer = (df if dealt else df.hint("rebalance", key)).write.options(**{k: v for k, v in options.items() if v is not None})
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_PARTS if dealt else None):
        writer.partitionBy(key).parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged).groupBy(F.col("_metadata.file_path").alias("file")).count().collect()      # a row per file
    counts: dict[str, int] = {}
    for r in rows:
        part = unquote(r["file"].split("/")[-2])
        counts[part] = counts.get(part, 0) + r["count"]
    said = {n: [e] for n, e in ((n, entry(spark, before, path, n)) for before in [commits(spark, path)] for n in before) if e}
    for name in _named(_children(spark, staged), key):
        said.setdefault(name, []).append({"files": _data_files(spark, f"{staged}/{name}"), "rows": counts.get(unquote(name), 0)})
    commit(spark, path, said)
    return staged


def put_part(spark: SparkSession, staged: str, path: str, name: str) -> None:
    """Give a staged part its place; the part that is there is kept until then."""
    path = path.rstrip("/")
    fs, target, aside = hadoop_fs(spark, path), f"{path}/{name}", f"{path}/{OLD}/{name}"
    if path_exists(spark, target):
        fs.mkdirs(hadoop_path(spark, f"{path}/{OLD}"))
        rename_path(spark, target, aside)
    rename_path(spark, f"{staged}/{name}", target)
    if path_exists(spark, aside):
        delete_path(spark, aside)


def drop_part(spark: SparkSession, path: str, name: str) -> None:
    if path_exists(spark, f"{path.rstrip('/')}/{name}"):
        delete_path(spark, f"{path.rstrip('/')}/{name}")


def recover(spark: SparkSession, path: str, key: str) -> list[str]:
    """Finish or take back what an earlier stop left; returns the names of the whole parts."""
    path = path.rstrip("/")
    said = commits(spark, path)
    for name in _children(spark, f"{path}/{OLD}"):
        if entry(spark, said, path, name) is None:
            drop_part(spark, path, name)
            rename_path(spark, f"{path}/{OLD}/{name}", f"{path}/{name}")
        else:
            delete_path(spark, f"{path}/{OLD}/{name}")
    whole = []
    for name in _children(spark, path):
        if name.startswith(".staged-"):
            delete_path(spark, f"{path}/{name}")
        elif name.startswith(f"{key}="):
            if entry(spark, said, path, name) is None:
                drop_part(spark, path, name)
            else:
                whole.append(name)
    return whole


def read_parts(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """All whole parts of a table; changes nothing."""
    path = path.rstrip("/")
    said = commits(spark, path)
    here = {n: path for n in _named(_children(spark, path), key) if entry(spark, said, path, n) is not None}
    here |= {n: f"{path}/{OLD}" for n in _named(_children(spark, f"{path}/{OLD}"), key) if n not in here}
    out = spark.createDataFrame([], schema)
    for base in sorted(set(here.values())):
        folders = [f"{base}/{n}" for n, b in sorted(here.items()) if b == base]
        out = out.unionByName(spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.names))
    return out


def part_rows(spark: SparkSession, path: str, key: str) -> dict[str, int]:
    """Row count of every whole part, as its commit says."""
    said = commits(spark, path)
    found = {n: entry(spark, said, path.rstrip("/"), n) for n in _named(_children(spark, path), key)}
    return {n: e["rows"] for n, e in found.items() if e}


def part_value(name: str, key: str) -> str | None:
    """The key's value (as text) that a part folder is named after."""
    value = unquote(name[len(key) + 1:])
    return None if value == NULL_PART else value


def add_missing_parts(df: DataFrame, path: str, key: str, **options) -> DataFrame:
    """Resumable append: whole parts stay as they are, the others are computed and added
    (the filter is applied before ``df`` is computed); returns the whole table."""
    spark, schema = df.sparkSession, df.schema
    done = [part_value(n, key) for n in recover(spark, path, key)]
    if done:
        value = F.coalesce(F.col(key).cast("string"), F.lit(NULL_PART))
        df = df.where(~value.isin([NULL_PART if v is None else v for v in done]))
    staged = stage_parts(df, path, key, **options)
    for name in _named(_children(spark, staged), key):
        put_part(spark, staged, path, name)
    delete_path(spark, staged)
    return read_parts(spark, path, key, schema)


def replace_parts(df: DataFrame, path: str, key: str, names: list[str], **options) -> None:
    """Replace the named parts by the rows of ``df``; a named part without rows is dropped."""
    spark = df.sparkSession
    recover(spark, path, key)
    staged = stage_parts(df, path, key, **options)
    new = set(_children(spark, staged))
    for name in names:
        if name in new:
            put_part(spark, staged, path, name)
        else:
            drop_part(spark, path, name)
    delete_path(spark, staged)
