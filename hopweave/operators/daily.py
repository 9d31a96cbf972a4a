"""Dense per-(address, day) activity features.

Scale notes
-----------
* The calendar is generated per account with ``explode(sequence(...))``; the
  first-seen day is the window start itself, so labelling needs no shuffle.
* Every per-day table is aggregated on (address, day) with map-side partial
  aggregation; the final left-join chain of ``d_core`` runs on one shared
  (address, day) hash partitioning.
* Sender aggregates are first reduced to (sender, day, receiver) rows before
  the contract lookup join, so a hot receiver (a popular contract) meets the
  lookup once per distinct sender-day, not once per transfer.
* Activity statistics never gather a day's timestamps into one array: events
  are reduced to one-minute bins (count, first, last).  Two events in the same
  minute bin are less than 60 s apart, i.e. 0 whole minutes, so the sorted
  interarrival gaps are zeros inside bins plus one gap between consecutive
  non-empty bins.  Mean, sample deviation, sessions, span and the 5-minute
  burst follow from at most 1,440 bin rows per address-day, however hot it is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.functions.common import (WEI_PER_ETH, WEI_PER_GWEI, as_of_ts, end_of_day, hash_shard, utc_ts, whole_hours,
                                       whole_minutes)
from hopweave.functions.membership import probable_members
from hopweave.operators import ledger_pass, parts
from hopweave.session import written

LN24 = math.log(24.0)
KEYS = ["address", "day"]
# Account lists are broadcast below this proven row count.
ACCOUNT_BROADCAST_ROWS = 200_000


# ---- accounts → calendar ------------------------------------------------------
def d_base(accounts: DataFrame) -> DataFrame:
    return accounts.where(F.col("activity_start_ts").isNotNull()).select(
        F.lower("address").alias("address"), "is_scam", "description", "is_contract",
        utc_ts("activity_start_ts").alias("activity_start_ts"),
        utc_ts("activity_end_ts").alias("activity_end_ts"))


def d_bounds(base: DataFrame, as_of_day) -> DataFrame:
    """Open end → ``as_of_day`` 23:59:59; drop windows that end before they start."""
    end = F.coalesce("activity_end_ts", as_of_ts(end_of_day(as_of_day)))
    return (base.where(F.col("activity_end_ts").isNull() | (F.col("activity_end_ts") >= F.col("activity_start_ts")))
            .select("address", "is_scam", "description", "is_contract", "activity_start_ts",
                    end.alias("activity_end_ts")))


#: Days of a partition of the calendar (an account's days stay together).
DAYS_A_PARTITION = 500_000


def by_address(df: DataFrame, days: int | None = None) -> DataFrame:
    """Hash-partition one-row-per-account input by address before it is expanded to days.

    Every later (address, day) table is then joined to the calendar, and the
    day-over-day window runs, on this one partitioning; a partition holds whole
    accounts, and an account has at most one row per day, so no key is skewed.
    The number of partitions follows the summed window lengths, ``days`` (counted by the
    caller), since adaptive execution may not change it afterwards; it is at least the
    session's shuffle setting (with fewer, Spark would shuffle the days to match the tables
    they are joined with).  Sorted accounts expand to sorted days, which a later sort by address
    and day only has to confirm.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, -(-(days or 0) // DAYS_A_PARTITION)), "address").sortWithinPartitions("address", "activity_start_ts")


def d_calendar(bounds: DataFrame) -> DataFrame:
    """One row per account and day of its window, both ends included."""
    return by_address(bounds).select("address", "is_scam", "description", "is_contract",
                         F.explode(F.sequence(F.to_date("activity_start_ts"), F.to_date("activity_end_ts"))).alias("day"))


def calendar_labels(day: Column, first_seen: Column) -> list:
    dow_sun1 = F.dayofweek(day)  # 1 = Sunday … 7 = Saturday
    return [
        first_seen.alias("first_seen_day"),
        F.datediff(day, first_seen).alias("age_days"),
        F.pmod(dow_sun1 + 5, F.lit(7)).alias("dow"),
        F.when(dow_sun1.isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.when(F.dayofmonth(day) == 1, 1).otherwise(0).alias("is_month_start"),
        F.when(F.last_day(day) == day, 1).otherwise(0).alias("is_month_end"),
    ]


def d_calendar_labels(bounds: DataFrame, days: int | None = None) -> DataFrame:
    """Calendar plus first day, age, weekday (0 = Monday), weekend and month-edge flags.

    The first calendar day of an account is the day of its window start, so
    no aggregation over the calendar is needed.
    """
    cal = by_address(bounds, days).select("address", "is_scam", "description", "is_contract",
                        F.to_date("activity_start_ts").alias("_first"),
                        F.explode(F.sequence(F.to_date("activity_start_ts"), F.to_date("activity_end_ts"))).alias("day"))
    return cal.select("address", "is_scam", "description", "is_contract", "day",
                      *calendar_labels(F.col("day"), F.col("_first")))


# ---- raw ledgers → bounded, normalised rows -------------------------------------
def _bounded(df: DataFrame, lo, hi) -> DataFrame:
    if lo is None:
        return df.where(F.lit(False))
    return df.where(F.col("day").between(F.lit(lo), F.lit(hi)))


def _eth(c) -> Column:
    return F.col(c).try_cast("double") / F.lit(WEI_PER_ETH)


def _wei(c) -> Column:
    return F.col(c).try_cast("decimal(38,0)")


def wei_to(unit: float, c) -> Column:
    """Exact wei total → double in ``unit`` (one rounding, same in every engine)."""
    return F.col(c).cast("double") / F.lit(unit) if isinstance(c, str) else c.cast("double") / F.lit(unit)


def d_tx_norm(tx: DataFrame, lo, hi) -> DataFrame:
    """Bounded, lower-cased transfers; amounts kept in exact wei beside ETH/gwei doubles."""
    ts = utc_ts("block_timestamp")
    out = tx.select(
        F.lower("from_address").alias("from_addr"), F.lower("to_address").alias("to_addr"),
        F.to_date(ts).alias("day"),
        _eth("value").alias("eth_value"),
        F.col("receipt_status").alias("status"),
        F.col("receipt_gas_used").try_cast("bigint").alias("gas_used"),
        (F.col("receipt_effective_gas_price").try_cast("double") / F.lit(WEI_PER_GWEI)).alias("gas_price_gwei"),
        (F.col("max_fee_per_gas").try_cast("double") / F.lit(WEI_PER_GWEI)).alias("max_fee_per_gas_gwei"),
        (F.col("max_priority_fee_per_gas").try_cast("double") / F.lit(WEI_PER_GWEI)).alias("priority_fee_gwei"),
        ts.alias("block_timestamp"),
        _wei("value").alias("value_wei"),
        _wei("receipt_effective_gas_price").alias("gas_price_wei"),
        _wei("max_fee_per_gas").alias("max_fee_wei"),
        _wei("max_priority_fee_per_gas").alias("priority_fee_wei"))
    return _bounded(out, lo, hi)


def d_contract_lookup(contracts: DataFrame) -> DataFrame:
    return contracts.select(F.lower("address").alias("address")).where(F.col("address").isNotNull()).distinct()


def _sent_pairs(txn: DataFrame) -> DataFrame:
    """Transfers reduced to (sender, day, receiver) partial aggregates (exact wei sums)."""
    return (txn.where(F.col("from_addr").isNotNull())
            .groupBy("from_addr", "day", "to_addr").agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("status") == 0).alias("failed"),
                F.sum("value_wei").alias("wei_sum"), F.max("eth_value").alias("eth_max"),
                F.count("value_wei").alias("eth_n"),
                F.sum(F.col("gas_used").cast("decimal(38,0)") * F.col("gas_price_wei")).alias("fee_wei"),
                F.sum("gas_used").alias("gas_sum"),
                F.sum("gas_price_wei").alias("gp_sum"), F.count("gas_price_wei").alias("gp_n"),
                F.sum("max_fee_wei").alias("mf_sum"), F.count("max_fee_wei").alias("mf_n"),
                F.sum("priority_fee_wei").alias("pf_sum"), F.count("priority_fee_wei").alias("pf_n")))


def _avg(s: str, n: str, unit: float) -> Column:
    return F.when(F.sum(n) > 0, wei_to(unit, F.sum(s)) / F.sum(n))


def d_sent(txn: DataFrame, contracts_lu: DataFrame) -> DataFrame:
    """Per (sender, day): counts, failures, ETH sum/max/avg, fees, gas, receiver type counts."""
    p = _sent_pairs(txn)
    lu = contracts_lu.select(F.col("address").alias("_c"), F.lit(True).alias("_is_c"))
    p = p.join(lu, p.to_addr == lu._c, "left")
    to_known = F.col("to_addr").isNotNull()
    return p.groupBy(F.col("from_addr").alias("address"), "day").agg(
        F.sum("n").alias("normal_sent_cnt"),
        F.sum("failed").alias("normal_failed_cnt"),
        wei_to(WEI_PER_ETH, F.sum("wei_sum")).alias("eth_sent_sum"),
        F.max("eth_max").alias("eth_sent_max"),
        _avg("wei_sum", "eth_n", WEI_PER_ETH).alias("eth_sent_avg"),
        wei_to(WEI_PER_ETH, F.sum("fee_wei")).alias("tx_fee_eth_sum"),
        F.sum("gas_sum").alias("gas_used_sum"),
        _avg("gp_sum", "gp_n", WEI_PER_GWEI).alias("gas_price_avg_gwei"),
        _avg("mf_sum", "mf_n", WEI_PER_GWEI).alias("max_fee_per_gas_avg_gwei"),
        _avg("pf_sum", "pf_n", WEI_PER_GWEI).alias("priority_fee_avg_gwei"),
        F.coalesce(F.sum(F.when(to_known & F.col("_is_c").isNotNull(), F.col("n"))), F.lit(0)).alias("normal_to_contract_cnt"),
        F.coalesce(F.sum(F.when(to_known & F.col("_is_c").isNull(), F.col("n"))), F.lit(0)).alias("normal_to_eoa_cnt"))


def d_recv(txn: DataFrame) -> DataFrame:
    return (txn.where(F.col("to_addr").isNotNull())
            .groupBy(F.col("to_addr").alias("address"), "day").agg(
                F.count(F.lit(1)).alias("normal_recv_cnt"),
                wei_to(WEI_PER_ETH, F.sum("value_wei")).alias("eth_recv_sum"),
                F.max("eth_value").alias("eth_recv_max"),
                (wei_to(WEI_PER_ETH, F.sum("value_wei")) / F.count("value_wei")).alias("eth_recv_avg")))


def d_token_norm(tt: DataFrame, lo, hi) -> DataFrame:
    out = tt.select(F.lower("from_address").alias("from_addr"), F.lower("to_address").alias("to_addr"),
                    F.lower("token_address").alias("token"), F.to_date(utc_ts("block_timestamp")).alias("day"))
    return _bounded(out, lo, hi)


def d_token_sent(tk: DataFrame) -> DataFrame:
    return (tk.where(F.col("from_addr").isNotNull())
            .groupBy(F.col("from_addr").alias("address"), "day")
            .agg(F.count(F.lit(1)).alias("erc20_sent_cnt"), F.count_distinct("token").alias("erc20_unique_tokens_sent")))


def d_token_recv(tk: DataFrame) -> DataFrame:
    return (tk.where(F.col("to_addr").isNotNull())
            .groupBy(F.col("to_addr").alias("address"), "day")
            .agg(F.count(F.lit(1)).alias("erc20_recv_cnt"), F.count_distinct("token").alias("erc20_unique_tokens_recv")))


def d_trace_norm(traces: DataFrame, lo, hi) -> DataFrame:
    ts = utc_ts("block_timestamp")
    out = traces.select(F.lower("from_address").alias("from_addr"), F.lower("to_address").alias("to_addr"),
                        F.to_date(ts).alias("day"), _eth("value").alias("eth_value"), "status", "call_type",
                        ts.alias("block_timestamp"), _wei("value").alias("value_wei"))
    return _bounded(out, lo, hi)


def _internal_rows(tr: DataFrame) -> DataFrame:
    ok = (F.col("status") == 1) & (F.col("eth_value") > 0)
    out = tr.where(ok & F.col("from_addr").isNotNull()).select(
        "day", F.col("from_addr").alias("address"), F.lit("out").alias("dir"), "value_wei",
        F.col("block_timestamp").alias("ts"))
    inn = tr.where(ok & F.col("to_addr").isNotNull()).select(
        "day", F.col("to_addr").alias("address"), F.lit("in").alias("dir"), "value_wei",
        F.col("block_timestamp").alias("ts"))
    return out.unionByName(inn)


def d_burst_dense(events: DataFrame, calendar: DataFrame | None = None, burst_minutes: int = 5) -> DataFrame:
    """Reference form of the burst: dense minute grid, zero-filled, rolling row frame.

    Kept for verification of the sparse range-frame form; it materialises every
    minute between a day's first and last event, as an array of at most 1,440 counts in the
    day's row: the minutes of the grid are neither joined, shuffled nor sorted.
    """
    minute = (F.unix_seconds("m") / 60).cast("bigint")
    bins = minute_bins(events, calendar).where(F.col("m").isNotNull()).select(*KEYS, F.struct(minute.alias("m"), "cnt").alias("bin"))
    days = bins.groupBy(*KEYS).agg(F.sort_array(F.collect_list("bin")).alias("bins"))
    zero = F.lit(0).cast("bigint")

    def with_idle(b, i):
        """A bin's count and the zeros up to the next bin."""
        idle = F.coalesce(F.get("bins", i + 1)["m"] - b["m"] - 1, zero)
        return F.concat(F.array(b["cnt"]), F.array_repeat(zero, idle.cast("int")))

    grid = days.select(*KEYS, F.flatten(F.transform("bins", with_idle)).alias("grid"))
    rolled = F.transform("grid", lambda cnt, i: sum((F.coalesce(F.get("grid", i - back), zero) for back in range(1, burst_minutes)), cnt))
    return grid.select(*KEYS, F.array_max(rolled).alias("burst_max_tx_5m"))


def of_accounts(rows: DataFrame, accounts: DataFrame | None, side: str = "address") -> DataFrame:
    """Rows whose ``side`` is one of the accounts (all rows without a list): applied before
    any aggregation, so the rest of the chain is never shuffled."""
    if accounts is None:
        return rows
    return rows.join(accounts.select(F.col("address").alias("_account")), F.col(side) == F.col("_account"), "left_semi")


def d_internal(tr: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Successful internal ETH movements: per (address, day) out/in counts and sums."""
    r = of_accounts(_internal_rows(tr), accounts)
    is_out, is_in = F.col("dir") == "out", F.col("dir") == "in"
    return r.groupBy("address", "day").agg(
        F.sum(F.when(is_out, 1).otherwise(0)).cast("bigint").alias("internal_out_cnt"),
        F.sum(F.when(is_in, 1).otherwise(0)).cast("bigint").alias("internal_in_cnt"),
        wei_to(WEI_PER_ETH, F.sum(F.when(is_out, F.col("value_wei")).otherwise(F.lit(0)))).alias("internal_out_value_eth_sum"),
        wei_to(WEI_PER_ETH, F.sum(F.when(is_in, F.col("value_wei")).otherwise(F.lit(0)))).alias("internal_in_value_eth_sum"))


def activity_events(txn: DataFrame, tr: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Every timestamp that enters a day's activity list: sent, received, internal.

    A self-transfer contributes its timestamp twice (once per side).
    """
    sent = txn.where(F.col("from_addr").isNotNull()).select(F.col("from_addr").alias("address"), "day",
                                                            F.col("block_timestamp").alias("ts"))
    recv = txn.where(F.col("to_addr").isNotNull()).select(F.col("to_addr").alias("address"), "day",
                                                          F.col("block_timestamp").alias("ts"))
    internal = _internal_rows(tr).select("address", "day", "ts")
    return of_accounts(sent.unionByName(recv).unionByName(internal).where(F.col("ts").isNotNull()), accounts)


def account_events(txn: DataFrame, tr: DataFrame, bounds: DataFrame, broadcast_rows: int = ACCOUNT_BROADCAST_ROWS) -> DataFrame:
    """The events of the accounts, for steps that match them to the calendar.

    A list too long to broadcast is tested by bit pages where the ledger is read (a few
    events of other accounts pass), so no event is shuffled for it.
    """
    listed = bounds.select("address").where(F.col("address").isNotNull()).distinct()
    if listed.count() <= broadcast_rows:
        return activity_events(txn, tr, F.broadcast(listed))
    return probable_members(activity_events(txn, tr), listed, ["address"])


def d_activity_list(calendar: DataFrame, events: DataFrame) -> DataFrame:
    """(address, day, sorted timestamps) for every calendar day; [] when idle.

    Output table only: nothing downstream needs the gathered arrays.
    """
    lists = events.groupBy(*KEYS).agg(F.array_sort(F.collect_list("ts")).alias("ts_all"))
    return (calendar.select(*KEYS).join(lists, KEYS, "left")
            .select(*KEYS, F.coalesce("ts_all", F.array().cast("array<timestamp>")).alias("ts_all")))


def minute_bins(events: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """(address, day, minute, count, first ts, last ts); optionally only calendar days.

    Events are binned first (partial aggregation before the shuffle), and only
    the bins — at most 1,440 per account-day — are matched to the calendar, so a
    hot account never sends its raw events to one partition.  The calendar is hashed part by
    part: its files are small, but its days are many, so it must not be broadcast.
    """
    bins = events.groupBy("address", "day", F.date_trunc("minute", "ts").alias("m")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    if calendar is not None:
        bins = bins.join(calendar.select(*KEYS).hint("shuffle_hash"), KEYS, "left_semi")
    return bins


def _day_stats(bins: DataFrame, burst_minutes: int = 5, session_gap_min: int = 30) -> DataFrame:
    """Per (address, day) interarrival, span, burst, session and hour-of-day statistics."""
    w = Window.partitionBy(*KEYS).orderBy("_minute")                    # both frames in one order: bins are sorted once
    wr = w.rangeBetween(-(burst_minutes - 1), 0)
    b = bins.withColumn("_minute", (F.unix_seconds(F.col("m")) / 60).cast("bigint")).select("*",
                    whole_minutes(F.lag("t1").over(w), F.col("t0")).alias("gap"),
                    F.sum("cnt").over(wr).alias("roll"),
                    F.hour("m").alias("h"))
    hour_cnt = [F.sum(F.when(F.col("h") == h, F.col("cnt")).otherwise(0)).alias(f"_h{h}") for h in range(24)]
    return b.groupBy(*KEYS).agg(
        F.sum("cnt").alias("n"),
        F.sum("gap").alias("g1"),
        F.sum(F.col("gap").cast("double") * F.col("gap")).alias("g2"),
        F.count_if(F.col("gap") > session_gap_min).alias("long_gaps"),
        F.min("t0").alias("first_ts"), F.max("t1").alias("last_ts"),
        F.max("roll").alias("burst"),
        *hour_cnt)


def day_stats(calendar: DataFrame, events: DataFrame, burst_minutes: int = 5,
              session_gap_min: int = 30) -> DataFrame:
    """Shared per-(address, day) bin statistics behind activity stats and hour profile."""
    return _day_stats(minute_bins(events, calendar), burst_minutes, session_gap_min)


def _activity_columns() -> list:
    """Interarrival, span, burst and session columns of a day's bin statistics."""
    n, g1, g2 = F.col("n"), F.coalesce(F.col("g1"), F.lit(0)).cast("double"), F.coalesce(F.col("g2"), F.lit(0.0))
    gaps = (n - 1).cast("double")
    var = (g2 - g1 * g1 / gaps) / (gaps - 1)
    return [F.when(n >= 2, g1 / gaps).alias("tx_interarrival_mean_min"),
            F.when(n >= 3, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("tx_interarrival_std_min"),
            F.when(n >= 2, whole_minutes("first_ts", "last_ts")).otherwise(0).cast("bigint").alias("active_span_min"),
            F.col("burst").cast("bigint").alias("burst_max_tx_5m"),
            (F.lit(1) + F.col("long_gaps")).cast("bigint").alias("sessions_cnt")]


def _hour_columns() -> list:
    """Hour-of-day columns of a day's bin statistics."""
    hs = [F.col(f"_h{h}") for h in range(24)]
    total = F.col("n")
    b = [sum(hs[i] for i in range(lo, lo + 6)) for lo in (0, 6, 12, 18)]
    peak_cnt = F.greatest(*hs)
    ent = sum(F.when(h > 0, -(h / total) * F.log(h / total)).otherwise(F.lit(0.0)) for h in hs)
    return [b[0].cast("bigint").alias("tx_cnt_00_06"), b[1].cast("bigint").alias("tx_cnt_06_12"),
            b[2].cast("bigint").alias("tx_cnt_12_18"), b[3].cast("bigint").alias("tx_cnt_18_24"),
            F.try_divide(b[0], total).alias("night_share"),
            (F.array_position(F.array(*hs), peak_cnt) - 1).cast("bigint").alias("peak_hour"),
            F.try_divide(peak_cnt, total).alias("peak_hour_share"),
            F.when(total > 1, ent / F.lit(LN24) + F.lit(0.0)).alias("activity_entropy_hours"),
            whole_hours("first_ts", "last_ts").cast("bigint").alias("active_hour_span")]


def activity_of_days(stats: DataFrame) -> DataFrame:
    """All activity columns of the days with events."""
    return stats.select(*KEYS, *_activity_columns(), *_hour_columns())


def d_activity_stats(calendar: DataFrame, events: DataFrame | None, burst_minutes: int = 5,
                     session_gap_min: int = 30, stats: DataFrame | None = None) -> DataFrame:
    """Interarrival mean/sample-std (whole minutes), active span, max events in any
    ``burst_minutes`` window, sessions (1 + gaps > ``session_gap_min``); every calendar day."""
    s = stats if stats is not None else day_stats(calendar, events, burst_minutes, session_gap_min)
    return (calendar.select(*KEYS).join(s.select(*KEYS, *_activity_columns()), KEYS, "left").select(
        *KEYS, "tx_interarrival_mean_min", "tx_interarrival_std_min",
        *[_z(c).cast("bigint").alias(c) for c in ("active_span_min", "burst_max_tx_5m", "sessions_cnt")]))


def d_hour_profile(calendar: DataFrame, events: DataFrame | None, stats: DataFrame | None = None) -> DataFrame:
    """Only days with events: six-hour buckets, night share, peak hour and its share,
    normalised hour entropy (NULL for ≤ 1 event), whole hours first → last."""
    s = stats if stats is not None else day_stats(calendar, events)
    return s.select(*KEYS, *_hour_columns())


def d_peers(txn: DataFrame, contracts_lu: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Distinct counterparties per (address, day) over normal transfers, both directions,
    split into contracts and others (definition inferred; the source never defines it)."""
    rows = txn.where(F.col("from_addr").isNotNull() & F.col("to_addr").isNotNull())
    sides = F.explode(F.array(
        F.struct(F.col("from_addr").alias("a"), F.col("to_addr").alias("p")),
        F.struct(F.col("to_addr").alias("a"), F.col("from_addr").alias("p"))))
    rows = rows.select("day", sides.alias("s")).select(F.col("s.a").alias("address"), "day", F.col("s.p").alias("peer"))
    peers = of_accounts(rows, accounts).distinct()
    lu = contracts_lu.select(F.col("address").alias("_c"))
    flagged = peers.join(lu, peers.peer == lu._c, "left")
    return flagged.groupBy("address", "day").agg(
        F.count(F.lit(1)).alias("uniq_peers_cnt"),
        F.count_if(F.col("_c").isNotNull()).alias("uniq_contract_peers_cnt"),
        F.count_if(F.col("_c").isNull()).alias("uniq_eoa_peers_cnt"))


# Columns of the transfer stages.
RECV_COLS = ["normal_recv_cnt", "eth_recv_sum", "eth_recv_max", "eth_recv_avg"]
PEER_COLS = ["uniq_peers_cnt", "uniq_contract_peers_cnt", "uniq_eoa_peers_cnt"]
DAY_COLS = ["normal_sent_cnt", "normal_failed_cnt", "eth_sent_sum", "eth_sent_max", "eth_sent_avg", "tx_fee_eth_sum", "gas_used_sum",
            "gas_price_avg_gwei", "max_fee_per_gas_avg_gwei", "priority_fee_avg_gwei", "normal_to_contract_cnt", "normal_to_eoa_cnt",
            *RECV_COLS, *PEER_COLS]


def _z(c: str, zero=0) -> Column:
    return F.coalesce(F.col(c), F.lit(zero))


def d_core(cal_labeled: DataFrame, *tables: DataFrame) -> DataFrame:
    """Calendar left-joined with every day table on (address, day): counts and sums
    default to 0, averages and maxima stay NULL; totals and net flow."""
    j = cal_labeled
    for t in tables:
        j = j.join(t, KEYS, "left")
    return j.select(
        "address", "day", "is_contract", "first_seen_day", "age_days", "dow", "is_weekend", "is_month_start",
        "is_month_end",
        _z("normal_sent_cnt").alias("normal_sent_cnt"), _z("normal_recv_cnt").alias("normal_recv_cnt"),
        (_z("normal_sent_cnt") + _z("normal_recv_cnt")).alias("normal_total_cnt"),
        _z("normal_failed_cnt").alias("normal_failed_cnt"),
        _z("normal_to_contract_cnt").alias("normal_to_contract_cnt"),
        _z("normal_to_eoa_cnt").alias("normal_to_eoa_cnt"),
        _z("eth_sent_sum", 0.0).alias("eth_sent_sum"), _z("eth_recv_sum", 0.0).alias("eth_recv_sum"),
        (_z("eth_recv_sum", 0.0) - _z("eth_sent_sum", 0.0)).alias("eth_net_flow"),
        "eth_sent_max", "eth_sent_avg", "eth_recv_max", "eth_recv_avg",
        _z("tx_fee_eth_sum", 0.0).alias("tx_fee_eth_sum"), _z("gas_used_sum").alias("gas_used_sum"),
        "gas_price_avg_gwei", "max_fee_per_gas_avg_gwei", "priority_fee_avg_gwei",
        _z("erc20_sent_cnt").alias("erc20_sent_cnt"), _z("erc20_recv_cnt").alias("erc20_recv_cnt"),
        (_z("erc20_sent_cnt") + _z("erc20_recv_cnt")).alias("erc20_total_cnt"),
        _z("erc20_unique_tokens_sent").alias("erc20_unique_tokens_sent"),
        _z("erc20_unique_tokens_recv").alias("erc20_unique_tokens_recv"),
        _z("internal_out_cnt").alias("internal_out_cnt"), _z("internal_in_cnt").alias("internal_in_cnt"),
        _z("internal_out_value_eth_sum", 0.0).alias("internal_out_value_eth_sum"),
        _z("internal_in_value_eth_sum", 0.0).alias("internal_in_value_eth_sum"),
        _z("uniq_peers_cnt").alias("uniq_peers_cnt"),
        _z("uniq_contract_peers_cnt").alias("uniq_contract_peers_cnt"),
        _z("uniq_eoa_peers_cnt").alias("uniq_eoa_peers_cnt"),
        "tx_interarrival_mean_min", "tx_interarrival_std_min", _z("active_span_min").alias("active_span_min"),
        _z("burst_max_tx_5m").alias("burst_max_tx_5m"), _z("sessions_cnt").alias("sessions_cnt"),
        "tx_cnt_00_06", "tx_cnt_06_12", "tx_cnt_12_18", "tx_cnt_18_24", "night_share", "peak_hour",
        "peak_hour_share", "activity_entropy_hours", "active_hour_span")


def d_final(core: DataFrame) -> DataFrame:
    """Day-over-day change of peak hour, night share and hour entropy."""
    w = Window.partitionBy("address").orderBy("day")
    return core.select(
        "*",
        (F.col("peak_hour") - F.lag("peak_hour").over(w)).alias("shift_peak_hour"),
        (F.col("night_share") - F.lag("night_share").over(w)).alias("shift_night_share"),
        (F.col("activity_entropy_hours") - F.lag("activity_entropy_hours").over(w)).alias("shift_activity_entropy"))


class Stages(dict):
    """Stages by name; those of the ledger pass are made when one is first asked for."""

    def __init__(self, ready: dict, later: dict):
        super().__init__(ready)
        self._later = later

    def __missing__(self, name: str) -> DataFrame:
        self[name] = made = self._later[name](self)
        return made


def build_daily(accounts: DataFrame, tx: DataFrame, token_transfers: DataFrame, traces: DataFrame,
                contracts: DataFrame, as_of_day, materialize: bool = True) -> dict:
    """The whole daily build; returns every stage by name.

    Each ledger is read once, by the pass behind ``days`` (see ``ledger_pass``); with
    ``materialize`` its result is kept in a table, which all per-day stages read.
    """
    base = d_base(accounts)
    bounds = d_bounds(base, as_of_day)
    if materialize:                                                     # five steps read the accounts
        bounds = written(bounds, "daily-bounds")
    first, last = F.to_date("activity_start_ts"), F.to_date("activity_end_ts")
    # Two scalars bound every ledger scan (pushed down as day range filters), one sizes the calendar.
    r = bounds.agg(F.min(first).alias("lo"), F.max(last).alias("hi"), F.sum(F.datediff(last, first) + 1).alias("days")).first()
    lo, hi = r["lo"], r["hi"]
    txn, tk, tr = d_tx_norm(tx, lo, hi), d_token_norm(token_transfers, lo, hi), d_trace_norm(traces, lo, hi)
    lu = d_contract_lookup(contracts)
    ready = dict(base=base, bounds=bounds, calendar=d_calendar_labels(bounds, r["days"] or 0), txn=txn, contracts_lu=lu, tokens=tk, traces=tr)
    sent = [c for c in DAY_COLS if c not in RECV_COLS + PEER_COLS]
    some = lambda df, n, cols: df.where(F.col(n) > 0).select(*KEYS, *cols)
    later = dict(
        events=lambda s: account_events(txn, tr, bounds),
        days=lambda s: ledger_pass.ledger_days(txn, tk, tr, bounds, keep=materialize),
        transfers=lambda s: ledger_pass.transfer_days(s["days"], lu),
        held=lambda s: ledger_pass.token_days(s["days"]),
        internal=lambda s: ledger_pass.internal_days(s["days"]),
        bins=lambda s: _day_stats(ledger_pass.window_minutes(s["days"], bounds)),
        sent=lambda s: some(s["transfers"], "normal_sent_cnt", sent),
        recv=lambda s: some(s["transfers"], "normal_recv_cnt", RECV_COLS),
        peers=lambda s: some(s["transfers"], "uniq_peers_cnt", PEER_COLS),
        tok_sent=lambda s: some(s["held"], "erc20_sent_cnt", ["erc20_sent_cnt", "erc20_unique_tokens_sent"]),
        tok_recv=lambda s: some(s["held"], "erc20_recv_cnt", ["erc20_recv_cnt", "erc20_unique_tokens_recv"]),
        stats=lambda s: d_activity_stats(s["calendar"], None, stats=s["bins"]),
        hourly=lambda s: d_hour_profile(s["calendar"], None, stats=s["bins"]),
        core=lambda s: d_core(s["calendar"], s["transfers"], s["held"], s["internal"], activity_of_days(s["bins"])),
        final=lambda s: d_final(s["core"]))
    return Stages(ready, later)


def reload_shards(df: DataFrame, path: str, n: int, lo: int, hi: int, group: DataFrame | None = None, key: str = "address") -> None:
    """Delete the rows of hash shards ``lo`` .. ``hi`` (of ``n``), then insert those of ``df``.

    Stored days that the reload no longer has are gone afterwards; other shards are not
    touched.  With ``group`` (a table of addresses) only the group's rows are deleted and
    inserted, the shards' other rows stay.  Each shard folder is replaced as a whole, the old
    one is kept until its successor is committed; a stop loses nothing (see ``parts``).
    """
    spark = df.sparkSession
    shard = hash_shard(key, n)
    mine = shard.between(lo, hi)
    rows = df.where(mine)
    if group is not None:
        members = group.select(F.lower("address").alias("_member")).distinct()
        rows = rows.join(members, F.lower(F.col(key)) == F.col("_member"), "left_semi")
        parts.recover(spark, path, "shard")
        stored = stored_shards(spark, path, df.schema).drop("shard").where(mine)
        rows = rows.unionByName(stored.join(members, F.lower(F.col(key)) == F.col("_member"), "left_anti"))
    parts.replace_parts(rows.withColumn("shard", shard), path, "shard", [f"shard={k}" for k in range(lo, hi + 1)])


def stored_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    """All committed rows of a table that ``reload_shards`` writes, with their shard."""
    return parts.read_parts(spark, path, "shard", T.StructType([*schema.fields, T.StructField("shard", T.LongType())]))
