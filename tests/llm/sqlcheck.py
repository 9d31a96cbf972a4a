"""Compare a Spark result with an operator's SQL, run by DuckDB over small tables."""

from collections import Counter

import duckdb


def rows_of_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    rel = con.sql(sql)
    return rel.columns, Counter(rel.fetchall())


def same(df, sql, **tables):
    columns, want = rows_of_sql(sql, **tables)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    assert sorted(df.columns) == sorted(columns)
    assert got == want
    return want
