"""One pass over the three ledgers for all daily features.

Every ledger row is turned once into tagged rows (address, day, kind, key, m), one per feature
family it feeds:

    p  key: the counterparty of a transfer, measures of both directions side by side
    t  key: the token of a token transfer
    i  internal ETH movement (no key)
    m  m: the minute of an activity timestamp (count, first, last)

and one aggregation with map-side partial sums reduces them.  Its exchange is the only one that
ledger rows enter, and it is dealt by address, day and key or minute, so an exchange
wallet's rows spread over all its counterparties and minutes instead of meeting in one task.
What is left (a row per account, day and counterparty, token or minute) is kept in a table
partitioned by kind; the per-day tables come from it with a second partial aggregation.

Rows of other accounts are dropped where the ledger is read: by a broadcast list when a count
proves it small, else by bit pages.  What the pages let through is dropped exactly: the few foreign
addresses are found in the kept table and left out where it is read, so the wide rows are neither
shuffled by address nor sorted for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopweave.functions.common import WEI_PER_ETH, WEI_PER_GWEI
from hopweave.functions.membership import probable_members
from hopweave.session import setting, written

#: Account lists are broadcast below this counted number of rows.
ACCOUNT_BROADCAST_ROWS = 200_000

TAG = ["address", "day", "kind", "key", "m"]
#: Kinds of rows; the kept table is written with an open file for each, so rows are not sorted by kind.
KINDS = 4
#: Shuffled bytes of a task that adds up and writes tagged rows: wide rows, so many times that in memory.
TASK_BYTES = 16 << 20
# Measures of a tagged row and how they add up; _s: sent or out, _r: received or in.
_TYPES = {"n_s": "bigint", "n_r": "bigint", "failed": "bigint", "wei_s": "decimal(38,0)", "wei_r": "decimal(38,0)", "wei_s_n": "bigint",
          "wei_r_n": "bigint", "max_s": "double", "max_r": "double", "fee": "decimal(38,0)", "gas": "bigint", "gp": "decimal(38,0)",
          "gp_n": "bigint", "mf": "decimal(38,0)", "mf_n": "bigint", "pf": "decimal(38,0)", "pf_n": "bigint", "t0": "timestamp", "t1": "timestamp"}
_BY = {"max_s": F.max, "max_r": F.max, "t0": F.min, "t1": F.max}


def _sides(rows: DataFrame, mine) -> DataFrame:
    """Every row once per side that is one of the accounts: ``dir`` s or r, ``address``, ``peer``."""
    sent = F.col("dir") == "s"
    both = rows.withColumn("dir", F.explode(F.array(F.lit("s"), F.lit("r"))))
    return mine(both.withColumns({"address": F.when(sent, F.col("from_addr")).otherwise(F.col("to_addr")),
                                  "peer": F.when(sent, F.col("to_addr")).otherwise(F.col("from_addr"))}).where(F.col("address").isNotNull()))


def _tagged(rows: DataFrame, kinds: list[str], key: Column, measures: dict[str, Column]) -> DataFrame:
    """Tagged rows of the given kinds; kind m takes the row's timestamp."""
    minute = F.col("kind") == "m"
    rows = rows.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds]))) if len(kinds) > 1 else rows.withColumn("kind", F.lit(kinds[0]))
    if "m" in kinds:
        rows = rows.where(~minute | F.col("block_timestamp").isNotNull())
        ts = F.when(minute, F.col("block_timestamp"))
        measures = {k: F.when(~minute, v) for k, v in measures.items()}
        measures["n_s"] = F.when(minute, F.lit(1)).otherwise(measures["n_s"])
        measures |= {"t0": ts, "t1": ts}
        m, key = F.date_trunc("minute", ts), F.when(~minute, key)
    else:
        m = F.lit(None).cast("timestamp")
    return rows.select("address", "day", "kind", key.cast("string").alias("key"), m.alias("m"),
                       *[measures.get(c, F.lit(None)).cast(t).alias(c) for c, t in _TYPES.items()])


def tagged_rows(txn: DataFrame, tokens: DataFrame, traces: DataFrame, mine=lambda df: df) -> DataFrame:
    """Tagged rows of normalised transfers, token transfers and successful internal movements.

    ``mine`` keeps the rows whose ``address`` is wanted.
    """
    sent, got = F.col("dir") == "s", F.col("dir") == "r"
    some = lambda c: F.when(F.col(c).isNotNull(), 1)
    of_sent = lambda c: F.when(sent, c)
    one = F.lit(1)
    counts = {"n_s": of_sent(one), "n_r": F.when(got, one)}
    wei = {"wei_s": of_sent(F.col("value_wei")), "wei_r": F.when(got, F.col("value_wei"))}
    transfers = _tagged(_sides(txn, mine), ["p", "m"], F.col("peer"), {
        **counts, **wei, "failed": of_sent(F.when(F.col("status") == 0, 1)), "wei_s_n": of_sent(some("value_wei")), "wei_r_n": F.when(got, some("value_wei")),
        "max_s": of_sent(F.col("eth_value")), "max_r": F.when(got, F.col("eth_value")),
        "fee": of_sent(F.col("gas_used").cast("decimal(38,0)") * F.col("gas_price_wei")), "gas": of_sent(F.col("gas_used")),
        "gp": of_sent(F.col("gas_price_wei")), "gp_n": of_sent(some("gas_price_wei")), "mf": of_sent(F.col("max_fee_wei")),
        "mf_n": of_sent(some("max_fee_wei")), "pf": of_sent(F.col("priority_fee_wei")), "pf_n": of_sent(some("priority_fee_wei"))})
    ok = (F.col("status") == 1) & (F.col("eth_value") > 0)
    internal = _tagged(_sides(traces.where(ok), mine), ["i", "m"], F.lit(None), {**counts, **wei})
    held = _tagged(_sides(tokens, mine), ["t"], F.col("token"), counts)
    return transfers.unionByName(internal).unionByName(held)


def ledger_days(txn: DataFrame, tokens: DataFrame, traces: DataFrame, accounts: DataFrame, keep: bool = True,
                broadcast_rows: int = ACCOUNT_BROADCAST_ROWS) -> DataFrame:
    """The aggregated tagged rows of the accounts (one row per ``TAG``), kept in a table."""
    listed = accounts.select("address").where(F.col("address").isNotNull()).distinct()
    small = listed.count() <= broadcast_rows
    if small:
        rows = tagged_rows(txn, tokens, traces, lambda df: df.join(F.broadcast(listed), "address", "left_semi"))
    else:
        rows = tagged_rows(txn, tokens, traces, lambda df: probable_members(df, listed, ["address"]))
    days = rows.groupBy(*TAG).agg(*[_BY.get(c, F.sum)(c).cast(t).alias(c) for c, t in _TYPES.items()])
    if not keep:
        return days if small else days.join(listed, "address", "left_semi")
    spark = days.sparkSession
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", KINDS), \
            setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES):
        kept = written(days, "ledger-days", "kind")
    return kept if small else of_listed(kept, listed, broadcast_rows)


def of_listed(days: DataFrame, listed: DataFrame, broadcast_rows: int = ACCOUNT_BROADCAST_ROWS) -> DataFrame:
    """The rows of a kept table whose address is listed; the list holds almost all of its addresses."""
    found = written(days.select("address").distinct(), "ledger-addresses")      # else the join would come first, over all rows
    foreign = written(found.join(listed, "address", "left_anti"), "ledger-foreign")
    n = foreign.count()
    if not n:
        return days
    return days.join(F.broadcast(foreign) if n <= broadcast_rows else foreign, "address", "left_anti")


def _avg(total: str, n: str, unit: float) -> Column:
    return F.when(F.sum(n) > 0, F.sum(total).cast("double") / F.lit(unit) / F.sum(n))


def _count(c) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def transfer_days(days: DataFrame, contracts_lu: DataFrame) -> DataFrame:
    """Per (address, day): everything about transfers sent and received and their counterparties."""
    lu = contracts_lu.select(F.col("address").alias("_c"))
    pairs = days.where("kind = 'p'").join(lu, F.col("key") == F.col("_c"), "left")
    known, is_c = F.col("key").isNotNull(), F.col("_c").isNotNull()
    # a peer counts once, whatever the direction, when both ends of the transfer are known
    eth = lambda c: F.sum(c).cast("double") / F.lit(WEI_PER_ETH)
    return pairs.groupBy("address", "day").agg(
        _count("n_s").alias("normal_sent_cnt"), _count("failed").alias("normal_failed_cnt"), eth("wei_s").alias("eth_sent_sum"),
        F.max("max_s").alias("eth_sent_max"), _avg("wei_s", "wei_s_n", WEI_PER_ETH).alias("eth_sent_avg"), eth("fee").alias("tx_fee_eth_sum"),
        F.sum("gas").alias("gas_used_sum"), _avg("gp", "gp_n", WEI_PER_GWEI).alias("gas_price_avg_gwei"),
        _avg("mf", "mf_n", WEI_PER_GWEI).alias("max_fee_per_gas_avg_gwei"), _avg("pf", "pf_n", WEI_PER_GWEI).alias("priority_fee_avg_gwei"),
        _count(F.when(known & is_c, F.col("n_s"))).alias("normal_to_contract_cnt"), _count(F.when(known & ~is_c, F.col("n_s"))).alias("normal_to_eoa_cnt"),
        _count("n_r").alias("normal_recv_cnt"), eth("wei_r").alias("eth_recv_sum"), F.max("max_r").alias("eth_recv_max"),
        _avg("wei_r", "wei_r_n", WEI_PER_ETH).alias("eth_recv_avg"),
        F.count_if(known).alias("uniq_peers_cnt"), F.count_if(known & is_c).alias("uniq_contract_peers_cnt"),
        F.count_if(known & ~is_c).alias("uniq_eoa_peers_cnt"))


def token_days(days: DataFrame) -> DataFrame:
    """Per (address, day): token transfers and distinct tokens, both directions."""
    return days.where("kind = 't'").groupBy("address", "day").agg(
        _count("n_s").alias("erc20_sent_cnt"), F.count_if(F.col("n_s").isNotNull() & F.col("key").isNotNull()).alias("erc20_unique_tokens_sent"),
        _count("n_r").alias("erc20_recv_cnt"), F.count_if(F.col("n_r").isNotNull() & F.col("key").isNotNull()).alias("erc20_unique_tokens_recv"))


def internal_days(days: DataFrame) -> DataFrame:
    """Per (address, day): internal ETH movements, one row of the kept table each."""
    eth = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double") / F.lit(WEI_PER_ETH)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return days.where("kind = 'i'").select(
        "address", "day", zero("n_s").alias("internal_out_cnt"), zero("n_r").alias("internal_in_cnt"),
        eth("wei_s").alias("internal_out_value_eth_sum"), eth("wei_r").alias("internal_in_value_eth_sum"))


def window_minutes(days: DataFrame, bounds: DataFrame) -> DataFrame:
    """Minute bins (address, day, m, cnt, t0, t1) of the days inside their account's window."""
    spans = bounds.select(F.col("address").alias("_a"), F.to_date("activity_start_ts").alias("_lo"), F.to_date("activity_end_ts").alias("_hi"))
    inside = (F.col("address") == F.col("_a")) & F.col("day").between(F.col("_lo"), F.col("_hi"))
    return days.where("kind = 'm'").select("address", "day", "m", F.col("n_s").alias("cnt"), "t0", "t1") \
        .join(spans.hint("shuffle_hash"), inside, "left_semi")          # the minutes pass by, unsorted
