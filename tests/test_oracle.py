"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import hashlib
import math
import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)


def test_every_query_has_a_builder_and_most_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    # operators of the optional subpackage (op1_..., pipeline) and queries that read files instead
    # of tables (test_file_manifest) have tests of their own
    files = {"pub_manifest_files", "pub_verify_files"}
    assert {n for n in set(q) - set(o) if n != "pipeline" and not n.startswith("op")} == files


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["seed_addr", "neighbor_addr", "day", "sum_value_wei", "last_ts"]
