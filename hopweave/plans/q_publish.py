"""Registered publishing queries.

Compaction and repack write under the session's shared checkpoint folder and read the
result back; manifest and verify hash document contents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hopweave.operators import publish as pub
from hopweave.plans.registry import register
from hopweave.session import stage_path
from hopweave.sources.tables import table

LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
                 "l_returnflag, l_linestatus, l_shipdate")


def _round(cols):
    out = []
    for c in cols.split(", "):
        if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"):
            out.append(f"floor({c} * 1e6 + 0.5) / 1e6 as {c}")
        elif c == "l_linenumber":
            out.append(f"cast({c} as bigint) as {c}")
        else:
            out.append(c)
    return ", ".join(out)


@register("pub_compact", sql=f"select {_round(LINEITEM_COLS)} from lineitem")
def q_compact(spark, sf_dir):
    """Line items rewritten as zstd parts of at most 100,000 rows, read back."""
    return pub.pub_compact(spark, f"{sf_dir}/lineitem.parquet", stage_path(spark, "compact_lineitem"),
                           rows_per_file=100_000)


@register("pub_repack_validated", sql="select count(*) as rows_in, count(*) as rows_out, true as published from orders")
def q_repack(spark, sf_dir):
    """Orders repacked through a staging folder; published only when counts match."""
    return pub.pub_repack_validated(spark, f"{sf_dir}/orders.parquet", stage_path(spark, "repack_orders_staging"),
                                    stage_path(spark, "repack_orders"))


# Checksums are a function of (path, content): registered over the documents table, each text a
# file; the file walk around it is tested on real files.
_FILES_SQL = ("select concat('doc/', doc_id) as path, cast(octet_length(encode(coalesce(text, ''))) as bigint) as size, "
              "sha256(coalesce(text, '')) as sha256, md5(coalesce(text, '')) as md5 from documents")


def _content_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    return pub.checksum_rows(docs, "text", ["path"])


@register("pub_manifest", sql=_FILES_SQL)
def q_manifest(spark, sf_dir):
    """Size, sha256 and md5 of every document's content."""
    return _content_manifest(spark, sf_dir)


@register("pub_verify", sql=f"""WITH m AS ({_FILES_SQL}), d AS (select *, cast(substr(path, 5) as bigint) as k from m)
select path, case when k % 7 = 1 then 'missing' when k % 7 = 2 then 'not listed' when k % 7 = 3 then 'mismatch' else 'ok' end as status from d""")
def q_verify(spark, sf_dir):
    """A stored manifest (history of JSON lines) against content that has since lost, gained and changed files by rule."""
    k = F.substring("path", 5, 20).cast("bigint") % 7
    now = _content_manifest(spark, sf_dir)
    history = stage_path(spark, "manifest_history")
    pub.append_manifest(now.where(k != 2), history, "first")
    listed = spark.read.json(history)
    changed = now.where(k != 1).withColumn("sha256", F.when(k == 3, F.reverse("sha256")).otherwise(F.col("sha256")))
    return pub.pub_verify(listed, changed)


@register("pub_manifest_files")
def q_manifest_files(spark, sf_dir):
    """Size, sha256 and md5 of every published file below the data folder (no SQL: it reads files)."""
    return pub.pub_manifest(spark, sf_dir).drop("mtime")


@register("pub_verify_files")
def q_verify_files(spark, sf_dir):
    """A manifest of the data folder's files, stored as JSON lines, against the files as they are."""
    now = pub.pub_manifest(spark, sf_dir)
    history = stage_path(spark, "file_manifest_history")
    pub.append_manifest(now, history, "first")
    return pub.pub_verify(spark.read.json(history), now)
