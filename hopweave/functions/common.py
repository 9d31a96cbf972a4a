"""Column expressions shared by all operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must equal the source pipeline's) -----------------------
# Address format: lowercase/uppercase hex, 0x prefix, 40 hex digits.
ADDRESS_PATTERN = r"^0x[a-fA-F0-9]{40}$"
# Smallest transfer kept on graph edges ("dust" filter), in wei.
DUST_WEI = 100_000_000_000_000
# Wei per ETH and per gwei.
WEI_PER_ETH = 1e18
WEI_PER_GWEI = 1e9

WEEK_MONDAY_FMT = "yyyy-MM-dd"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_address(c) -> Column:
    """lower(trim(x)) — the canonical form of an address string."""
    return F.lower(F.trim(col_(c)))


def is_address(c) -> Column:
    return col_(c).rlike(ADDRESS_PATTERN)


def stable_hash(c) -> Column:
    """Deterministic non-negative 60-bit hash of a string.

    First 15 hex digits of md5, read as an integer.  Portable: DuckDB computes
    the same value with ``CAST('0x' || substr(md5(x), 1, 15) AS BIGINT)``.
    """
    return F.conv(F.substring(F.md5(col_(c).cast("string")), 1, 15), 16, 10).cast("bigint")


def hash_shard(c, n: int) -> Column:
    return F.pmod(stable_hash(c), F.lit(n))


def iso_week(d) -> Column:
    """ISO-8601 week label ``YYYY-Www`` (year of the ISO week, Monday start)."""
    d = col_(d)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def month_label(d) -> Column:
    return F.date_format(col_(d), "yyyy-MM")


#: Days whose labels are looked up (1970 to 2069, a few MB); those of other days are computed.
LABEL_DAYS = 36_525


def with_day_labels(df: DataFrame, day_text: bool = False) -> DataFrame:
    """``df`` with the ISO week and the month of its ``day``, for tables with many rows a day: the texts
    are made once per day, not once per row.  ``day_text``: the day as text, too."""
    d = F.date_from_unix_date(F.col("_no").cast("int"))
    labels = df.sparkSession.range(LABEL_DAYS).select(F.col("id").alias("_no")).select(
        "_no", iso_week(d).alias("_week"), month_label(d).alias("_month"), d.cast("string").alias("_text"))
    known = df.withColumn("_no", F.unix_date("day").cast("bigint")).join(F.broadcast(labels), "_no", "left")
    out = known.withColumns({"week": F.coalesce("_week", iso_week("day")), "month": F.coalesce("_month", month_label("day"))})
    if day_text:
        out = out.withColumn("day", F.coalesce("_text", F.col("day").cast("string")))
    return out.drop("_no", "_week", "_month", "_text")


def run_days(runs: DataFrame, measures: list, until: str = "until") -> DataFrame:
    """Every day of runs (``day`` .. ``until``): the first with its measures, the others with zeros."""
    rest = [c for c in runs.columns if c not in ("day", until, *measures)]
    rows = runs.select(*rest, "day", *measures, F.explode(F.sequence("day", until)).alias("_d"))
    active = F.col("_d") == F.col("day")
    return rows.select(*rest, F.col("_d").alias("day"), *[F.when(active, F.col(c)).alias(c) for c in measures]).fillna(0, measures)


def week_monday(d) -> Column:
    return F.date_trunc("week", col_(d)).cast("date")


def strict_greatest(*cols) -> Column:
    """GREATEST that returns NULL when any input is NULL (Spark's skips NULLs)."""
    cols = [col_(c) for c in cols]
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cols))


def utc_ts(c) -> Column:
    """Zone-less parquet timestamps are UTC instants: cast to TIMESTAMP."""
    return col_(c).cast("timestamp")


def whole_minutes(start, end) -> Column:
    return F.timestamp_diff("MINUTE", col_(start), col_(end))


def whole_hours(start, end) -> Column:
    return F.timestamp_diff("HOUR", col_(start), col_(end))


def as_of_ts(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def end_of_day(d: _dt.date | str) -> str:
    """``TIMESTAMP(DATETIME(d, "23:59:59"))`` as a literal string."""
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d[:10])
    return f"{d.isoformat()} 23:59:59"


def round_half_up(x: float) -> int:
    """SQL ROUND (half away from zero) for non-negative scalars; Python's is banker's."""
    return int(math.floor(x + 0.5)) if x >= 0 else -int(math.floor(-x + 0.5))


def null_like_to_null(c) -> Column:
    """Text placeholders meaning 'nothing' (``null``, ``none``, ``nan``, empty) → NULL."""
    t = F.trim(col_(c).cast("string"))
    return F.when(t.isNull() | F.lower(t).isin("null", "none", "nan", ""), F.lit(None)).otherwise(t)


def empty_to_null(c) -> Column:
    t = F.trim(col_(c).cast("string"))
    return F.when(t == "", F.lit(None)).otherwise(t)


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when a count proves it holds at most ``max_rows`` rows.

    Beyond the bound the frame is returned unhinted, so Spark plans a shuffle
    join (and AQE may still convert it at run time from real statistics).
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def day_bounds(df: DataFrame, day_col: str = "day") -> tuple:
    """(min, max) of a date column as Python scalars — two numbers, never data."""
    r = df.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi")).first()
    return r["lo"], r["hi"]


def existing(df: DataFrame, wanted) -> list:
    cols = set(df.columns)
    return [c for c in wanted if c in cols]


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
