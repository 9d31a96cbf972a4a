"""Query registry: one Spark builder and (where SQL can say it) one DuckDB oracle per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.sources.fixture_sql import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered checks (see FIXTURES.md: small k so top-k cuts).
AS_OF = "2024-01-31 23:59:59"
K1, K2, CAP = 3, 2, 2


def round6(c):
    """Round to 6 decimals with plain IEEE steps, so Spark and DuckDB agree bit for bit."""
    return F.floor(c.cast("double") * 1e6 + 0.5) / 1e6


ROUND6_SQL = "floor(cast({c} as double) * 1e6 + 0.5) / 1e6"


def portable(df: DataFrame) -> DataFrame:
    """Output types both engines render identically: dates and decimals as text,
    doubles rounded to 6 digits, zone-less timestamps as UTC timestamps."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DateType, T.DecimalType)):
            c = c.cast("string")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = round6(c)
        elif isinstance(t, T.TimestampNTZType):
            c = c.cast("timestamp")
        elif isinstance(t, T.IntegerType | T.ShortType | T.ByteType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def ensure_session_conf(spark: SparkSession) -> None:
    """Apply the library's session settings (UTC calendar, adaptive execution,
    co-partitioning) to a session created elsewhere."""
    from hopweave.session import BASE_CONF
    for k, v in BASE_CONF.items():
        if k.startswith("spark.ui") or spark.conf.get(k, None) == v:
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static settings cannot change at run time
            pass


def register(name: str, sql: str | None = None, fixtures=()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_conf(spark)
            return portable(fn(spark, sf_dir))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        run.raw = fn
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_fixtures(sql, fixtures) if fixtures else sql.strip()
        return fn
    return deco


def load_all():
    # Import side effects fill the registries.
    from hopweave.plans import (q_graph, q_daily, q_shrink, q_accounts,  # noqa: F401
                                q_windows, q_labels, q_publish)
    return QUERIES, ORACLE
