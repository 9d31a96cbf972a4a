"""Stand-in ledger tables derived from the driver tables.

The pipeline reads chain tables (transactions, token transfers, traces,
contracts) and labelled account lists.  These builders derive tables of the
same shape from ``events``, ``customer``, ``orders`` and ``lineitem`` so every
operator runs on data that grows with the scale factor.  ``sources.fixture_sql``
holds the same definitions as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hopweave.functions.common import run_days
from hopweave.sources.tables import table


def synth_address(c) -> Column:
    """``0xA`` + 39 zero-padded digits: a 42-character address with upper-case A."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit("0xA"), F.lpad(c.cast("string"), 39, "0"))


def _props_key() -> Column:
    return F.regexp_extract(F.col("props"), "[0-9]+", 0).cast("bigint")


def _wei(value_col: str) -> Column:
    return (F.round(F.col(value_col) * 100).cast("decimal(18,0)")
            * F.lit(1000000000000).cast("decimal(13,0)"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    gas_price = F.lit(20000000000) + (eid % 50) * 100000000
    return ev.select(
        F.concat(F.lit("0x"), F.md5(eid.cast("string"))).alias("hash"),
        synth_address("user_id").alias("from_address"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
         .otherwise(synth_address(_props_key())).alias("to_address"),
        eid.alias("block_number"),
        F.col("ts").cast("timestamp").alias("block_timestamp"),
        _wei("value").alias("value"),
        gas_price.alias("gas_price"),
        (F.lit(21000) + (eid % 1000) * 10).alias("receipt_gas_used"),
        gas_price.alias("receipt_effective_gas_price"),
        F.when(eid % 2 == 0, F.lit(None).cast("bigint")).otherwise(F.lit(40000000000)).alias("max_fee_per_gas"),
        F.when(eid % 2 == 0, F.lit(None).cast("bigint")).otherwise(F.lit(1500000000)).alias("max_priority_fee_per_gas"),
        F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.lit(1)).alias("receipt_status"),
        eid.alias("nonce"),
        F.when(F.col("event_type") == "click", F.lit("0x"))
         .when(F.col("event_type") == "view", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("0x"), F.md5(F.col("event_type")))).alias("input"),
    )


def token_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        synth_address("user_id").alias("from_address"),
        synth_address(_props_key()).alias("to_address"),
        synth_address(F.lit(1000000) + _props_key() % 7).alias("token_address"),
        F.col("ts").cast("timestamp").alias("block_timestamp"),
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        synth_address("user_id").alias("from_address"),
        synth_address(_props_key()).alias("to_address"),
        _wei("value").alias("value"),
        F.when(F.col("event_id") % 10 == 0, F.lit(0)).otherwise(F.lit(1)).alias("status"),
        F.lit("call").alias("call_type"),
        F.col("ts").cast("timestamp").alias("block_timestamp"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third customer is a deployed contract (a role assignment, not a sample)."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % 3 == 0).select(synth_address("c_custkey").alias("address"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        synth_address(k).alias("address"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("is_scam"),
        F.when(k % 5 == 0, F.lit("Binance hot wallet"))
         .when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("description"),
        F.when(k % 3 == 0, 1).otherwise(0).alias("is_contract"),
    )


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled accounts; every third one was never active (no start)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.lower(synth_address(k)).alias("address"),
        F.when(k % 3 != 1, F.make_date(F.lit(2024), F.lit(1), (F.lit(3) + k % 5).cast("int")).cast("timestamp")).alias("activity_start_ts"),
        F.when(k % 4 == 0, F.lit(None).cast("timestamp"))
         .otherwise(F.make_date(F.lit(2024), F.lit(1), (F.lit(20) + k % 5).cast("int")).cast("timestamp"))
         .alias("activity_end_ts"),
    )


def seed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds joined with their account flags: the balanced-table shape used by the daily build."""
    acc = accounts(spark, sf_dir).select(F.lower("address").alias("address"), "is_scam", "description", "is_contract")
    return seeds(spark, sf_dir).join(acc, "address", "inner").select(
        "address", "is_scam", "description", "is_contract", "activity_start_ts", "activity_end_ts")


#: Lines of a task that joins them with their orders; a task's memory then stays the same at any size.
LINES_A_PARTITION = 500_000


def window_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n = -(-li.count() // LINES_A_PARTITION)
    if n > spark.sparkContext.defaultParallelism:      # else adaptive execution leaves a task no more than that
        li, o = li.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    cents = F.round(F.col("l_extendedprice") * 100)
    return j.select(
        synth_address("o_custkey").alias("from_address"),
        synth_address(F.lit(1000000) + F.col("l_suppkey")).alias("to_address"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        cents.cast("decimal(18,0)").alias("value_wei"),
        F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("decimal(18,0)").alias("tx_fee_wei"),
        F.col("l_orderkey").alias("block_number"),
        (F.col("l_linenumber") == 1).alias("contract_creation"),
        F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                          F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                          F.col("l_shipdate").cast("date").cast("string"),
                          F.col("l_quantity").cast("int").cast("string"),
                          cents.cast("bigint").cast("string"))).alias("tx_hash"),
    )


def label_src_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        synth_address(k).alias("address"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("is_scam"),
        F.when(k % 4 == 0, F.lit("null")).otherwise(F.col("c_mktsegment")).alias("description"),
        F.lit(0).alias("src_order"),
        k.alias("row_no"),
    )


def label_src_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("  "), F.upper(synth_address("o_custkey"))).alias("address"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_scam"),
        F.col("o_orderpriority").alias("description"),
        F.lit(1).alias("src_order"),
        F.col("o_orderkey").alias("row_no"),
    )


def _orders_by_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lower(synth_address("o_custkey")).alias("address"),
        F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_orderstatus") == "O").cast("int").alias("is_open"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse per-customer days: only those with orders.

    ``normal_total_cnt`` = orders that day, ``erc20_total_cnt`` = open orders that
    day, internal counts 0, ``eth_recv_sum`` = order value / 1000.
    """
    per_day = _orders_by_account(spark, sf_dir).groupBy("address", "day").agg(
        F.count(F.lit(1)).alias("normal_total_cnt"),
        F.sum("is_open").cast("bigint").alias("erc20_total_cnt"),
        F.sum("cents").alias("cents"))
    zero = F.lit(0).cast("bigint")
    return per_day.select("address", "day", "normal_total_cnt", "erc20_total_cnt", zero.alias("internal_in_cnt"), zero.alias("internal_out_cnt"),
                          (F.col("cents").cast("double") / 1e5).alias("eth_recv_sum"))


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last order day of every customer with orders."""
    return _orders_by_account(spark, sf_dir).groupBy("address").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


#: Days of a partition of the expanded calendar; they are streamed, never sorted.
CALENDAR_DAYS_A_PARTITION = 4_000_000


def calendar_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the dense calendar, from the counted days of all spans."""
    days = order_spans(spark, sf_dir).agg(F.sum(F.datediff("last_day", "first_day") + 1).alias("n")).first()["n"]
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(days or 0) // CALENDAR_DAYS_A_PARTITION))


def day_runs(days: DataFrame, partitions: int, by: str | Column = "address") -> DataFrame:
    """Sparse days, each with the last of the idle days that follow it (``until``), hash-partitioned by
    ``by``, an expression of the address."""
    measures = [c for c in days.columns if c not in ("address", "day")]
    nxt = F.lead("day").over(Window.partitionBy(by, "address").orderBy("day"))      # by first: its partitioning holds
    known = F.col("address").isNotNull()                                        # days without an account are no account's
    return days.where(F.col("day").isNotNull()).repartition(partitions, by).select(
        "address", "day", *[F.when(known, F.col(c)).alias(c) for c in measures], F.coalesce(F.date_sub(nxt, 1), F.col("day")).alias("until"))


def every_day(days: DataFrame, partitions: int, by: str | Column = "address") -> DataFrame:
    """Dense form of sparse days: an account's every day from its first to its last, zeros filled in.

    Each active day brings the idle days up to the next one along, so days are neither joined nor
    sorted.  The table comes out hash-partitioned by ``by``, which later steps reuse without a shuffle.
    """
    return run_days(day_runs(days, partitions, by), [c for c in days.columns if c not in ("address", "day")])


def order_runs(spark: SparkSession, sf_dir: str, by: str | Column = "address") -> DataFrame:
    """``order_calendar`` with a row per run of days, for operators that generate the days themselves."""
    return day_runs(order_days(spark, sf_dir), calendar_partitions(spark, sf_dir), by)


def order_calendar(spark: SparkSession, sf_dir: str, by: str | Column = "address") -> DataFrame:
    """Dense form of ``order_days``: every day of every span, for operators that take dense tables."""
    return every_day(order_days(spark, sf_dir), calendar_partitions(spark, sf_dir), by)


def label_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings shaped like scraped label lists: customers (padded upper-case,
    malformed and plain addresses, empty tags) plus all orders (repeated
    addresses with other flags).  Every label reader is fed a projection of it."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"),
                                              F.col("c_nationkey") == F.col("n_nationkey"))
    a = synth_address("c_custkey")
    seg = F.col("c_mktsegment")
    cust = c.select(
        F.col("c_custkey").alias("row_no"),
        F.when(seg == "BUILDING", F.concat(F.lit("  "), F.upper(a), F.lit(" ")))
         .when(seg == "AUTOMOBILE", F.concat(F.lit("0x"), F.col("c_custkey").cast("string")))
         .otherwise(a).alias("address"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 1000, F.lit("")).otherwise(F.col("n_name")).alias("tag"),
        F.when(F.col("c_acctbal") < 0, F.lit("1")).otherwise(F.lit("0")).alias("flag"),
        seg.alias("segment"))
    o = table(spark, sf_dir, "orders").select(
        (F.lit(1000000000) + F.col("o_orderkey")).alias("row_no"),
        synth_address("o_custkey").alias("address"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("tag"),
        F.when(F.col("o_orderstatus") == "F", F.lit("1")).otherwise(F.lit("0")).alias("flag"),
        F.col("o_orderstatus").alias("segment"))
    return cust.unionByName(o)
