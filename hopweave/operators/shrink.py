"""Table shrinking (light projection, idle-week thinning, exclusions) and profiling.

Scale notes: week windows are partitioned by account and hold one row per
week (a few hundred per account at most), so no window sees an unbounded
group.  Profiles are single-pass aggregates (one job, not one scan per column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopweave.functions.common import week_monday

# Fixed column list of the light daily table (address, day and 26 measures).
LIGHT_COLUMNS = [
    "address", "day",
    "normal_sent_cnt", "normal_recv_cnt", "normal_total_cnt", "normal_failed_cnt",
    "normal_to_contract_cnt", "normal_to_eoa_cnt",
    "eth_sent_sum", "eth_recv_sum", "eth_net_flow",
    "tx_fee_eth_sum", "gas_used_sum",
    "erc20_sent_cnt", "erc20_recv_cnt", "erc20_total_cnt",
    "erc20_unique_tokens_sent", "erc20_unique_tokens_recv",
    "internal_out_cnt", "internal_in_cnt",
    "internal_out_value_eth_sum", "internal_in_value_eth_sum",
    "uniq_peers_cnt", "uniq_contract_peers_cnt", "uniq_eoa_peers_cnt",
    "active_span_min", "burst_max_tx_5m", "sessions_cnt",
]
# Fixed list of the columns whose zero share is profiled.
ZERO_PROFILE_COLUMNS = ["normal_sent_cnt", "normal_recv_cnt", "normal_total_cnt", "erc20_total_cnt",
                        "internal_in_cnt", "internal_out_cnt", "tx_fee_eth_sum", "burst_max_tx_5m"]
ACTIVITY_COLUMNS = ["normal_total_cnt", "erc20_total_cnt", "internal_in_cnt", "internal_out_cnt"]


def p_light(final: DataFrame) -> DataFrame:
    return final.select(*LIGHT_COLUMNS)


def p_day_activity(light: DataFrame, activity_cols=ACTIVITY_COLUMNS) -> DataFrame:
    """Adds the Monday of the day's week and the day's total activity."""
    act = sum((F.col(c) for c in activity_cols[1:]), F.col(activity_cols[0]))
    return light.select("*", week_monday("day").alias("week"), act.alias("day_activity"))


def p_week_marks(base: DataFrame) -> DataFrame:
    return base.groupBy("address", "week").agg(F.sum("day_activity").alias("week_activity"))


def p_idle_runs(marks: DataFrame, mode: str = "reference") -> DataFrame:
    """Numbers the idle runs of each account: ``run_no`` is the number of changes from an
    active to an idle week up to this week.

    ``mode="reference"``: an idle first week is no change, so such a series begins in run 0.
    ``mode="strict"``: it is one, so every stretch of idle weeks has a number of its own.
    """
    if mode not in ("reference", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    weeks = Window.partitionBy("address").orderBy("week")
    idle = ~F.coalesce(F.col("week_activity") > 0, F.lit(False))
    was_active = F.coalesce(F.lag(~F.col("is_idle")).over(weeks), F.lit(mode == "strict"))
    return marks.select("address", "week", "week_activity", idle.alias("is_idle")) \
        .withColumn("_opens", F.col("is_idle") & was_active) \
        .select("address", "week", "week_activity", "is_idle", F.count_if("_opens").over(weeks).alias("run_no"))


def p_run_place(runs: DataFrame, mode: str = "reference") -> DataFrame:
    """Place of each idle week in its run and the run's weeks (NULL on active weeks).

    In reference mode a run lasts until the next one begins, active weeks included; in
    strict mode it has its idle weeks only.
    """
    run = Window.partitionBy("address", "run_no")
    weeks = F.count(F.lit(1)) if mode == "reference" else F.count_if("is_idle")
    only_idle = lambda c: F.when(F.col("is_idle"), c)
    return runs.withColumns({"place": only_idle(F.count_if("is_idle").over(run.orderBy("week"))),
                             "run_weeks": only_idle(weeks.over(run))})


def p_keep_weeks(base: DataFrame, keep_every: int = 4, mode: str = "reference") -> DataFrame:
    """Daily rows of the weeks kept: active ones, the first and last place of a run, and
    every ``keep_every``-th place of runs of three weeks or more.

    The kept weeks of a partition are hashed and its days pass by them, so no day is sorted."""
    placed = p_run_place(p_idle_runs(p_week_marks(base), mode), mode)
    edge = (F.col("place") == 1) | (F.col("place") == F.col("run_weeks"))
    sampled = (F.col("run_weeks") >= 3) & (F.col("place") % keep_every == 1 % keep_every)
    kept = placed.where(~F.col("is_idle") | edge | sampled).select("address", "week")
    return base.join(kept.hint("shuffle_hash"), ["address", "week"], "left_semi")


def p_exclude_accounts(df: DataFrame, discarded: DataFrame) -> DataFrame:
    """Drop rows of discarded accounts (case-insensitive address match)."""
    ex = discarded.select(F.lower("address").alias("_lc")).distinct()
    return df.join(ex, F.lower(df["address"]) == ex["_lc"], "left_anti")


def q_null_fractions(df: DataFrame, columns) -> DataFrame:
    """One row: share of NULLs per column (``<col>_null_frac``)."""
    n = F.count(F.lit(1))
    return df.agg(*[(F.count_if(F.col(c).isNull()) / n).alias(f"{c}_null_frac") for c in columns])


def q_zero_fractions(df: DataFrame, columns=ZERO_PROFILE_COLUMNS) -> DataFrame:
    """Long form (col, zero_frac) in one pass, ordered by share descending."""
    n = F.count(F.lit(1))
    wide = df.agg(*[(F.count_if(F.col(c) == 0) / n).alias(c) for c in columns])
    return (wide.unpivot([], columns, "col", "zero_frac")
            .orderBy(F.desc("zero_frac"), F.asc("col")))


def zero_null_identities(daily: DataFrame) -> DataFrame:
    """Shape checks of a daily table: zero share of sent count vs null share of the sent
    average, zero share of the burst vs null share of the hour buckets (must be equal)."""
    n = F.count(F.lit(1))
    return daily.agg(
        (F.count_if(F.col("normal_sent_cnt") == 0) / n).alias("zero_sent"),
        (F.count_if(F.col("eth_sent_avg").isNull()) / n).alias("null_sent_avg"),
        (F.count_if(F.col("burst_max_tx_5m") == 0) / n).alias("zero_burst"),
        (F.count_if(F.col("tx_cnt_00_06").isNull()) / n).alias("null_hour_bucket"))
