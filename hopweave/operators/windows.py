"""Graph and series datasets cut into calendar windows (month ``YYYY-MM``, ISO week ``YYYY-Www``).

Scale notes
-----------
* One grouped job per frequency replaces the per-window scan loops: window
  index, node counts and targets are ``groupBy(window)`` aggregates over the
  whole edge table, and slices are a single ``partitionBy(window)`` write.
* Node counting explodes (src, dst) and uses ``count_distinct`` per window —
  Spark expands it into two aggregation stages with partial aggregation, so a
  hot node is de-duplicated before the shuffle.
* The label map (one row per labelled account) is joined without a hint;
  AQE broadcasts it at run time when its real size is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopweave.functions.common import existing, iso_week, month_label, run_days, stable_hash, utc_ts, with_day_labels
from hopweave.operators.parts import add_missing_parts

# ---- fixed values: measure columns of the series dataset ----------------------
ETH_NUMS = ["eth_sent_sum", "eth_recv_sum", "eth_net_flow", "tx_fee_eth_sum",
            "internal_out_value_eth_sum", "internal_in_value_eth_sum"]
INT_COUNTS = ["normal_sent_cnt", "normal_recv_cnt", "normal_total_cnt", "normal_failed_cnt",
              "normal_to_contract_cnt", "normal_to_eoa_cnt", "gas_used_sum",
              "erc20_sent_cnt", "erc20_recv_cnt", "erc20_total_cnt",
              "erc20_unique_tokens_sent", "erc20_unique_tokens_recv",
              "internal_out_cnt", "internal_in_cnt",
              "uniq_peers_cnt", "uniq_contract_peers_cnt", "uniq_eoa_peers_cnt",
              "sessions_cnt", "active_span_min", "burst_max_tx_5m"]
MAX_ONLY = {"burst_max_tx_5m"}
EDGE_COLS = ["src_id", "dst_id", "ts", "value_wei", "tx_fee_wei", "block_number", "contract_creation", "tx_hash"]


def node_id(c) -> Column:
    """Stable 60-bit id of a lower-cased address (NULL stays NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    low = F.lower(c)
    return F.when(low.isNotNull(), stable_hash(low))


def window_label(freq: str, ts_seconds="ts") -> Column:
    d = F.to_date(F.timestamp_seconds(F.col(ts_seconds)))
    if freq == "month":
        return month_label(d)
    if freq == "week":
        return iso_week(d)
    raise ValueError(f"unknown window {freq!r}")


def w_labels_map(labels: DataFrame) -> DataFrame:
    """(node_id, is_scam int8, is_contract int8, address, address_lc), one row per node id."""
    lab = labels.select(
        node_id("address").alias("node_id"),
        F.struct(F.lower("address").alias("address_lc"), F.col("address"),
                 F.col("is_scam").cast("tinyint").alias("is_scam"),
                 F.col("is_contract").try_cast("tinyint").alias("is_contract")).alias("r"))
    one = lab.groupBy("node_id").agg(F.min("r").alias("r"))
    return one.select("node_id", "r.is_scam", "r.is_contract", "r.address", "r.address_lc")


def w_targets_global(labels_map: DataFrame) -> DataFrame:
    return labels_map.select("node_id", "is_scam", "is_contract", "address")


def w_address_map(labels_map: DataFrame) -> DataFrame:
    return labels_map.select("address", "node_id")


def w_edges(daily_edges: DataFrame) -> DataFrame:
    """Edge list with hashed endpoints, unix-second timestamps and wei amounts as text."""
    return daily_edges.select(
        node_id("from_address").alias("src_id"),
        node_id("to_address").alias("dst_id"),
        F.unix_seconds(utc_ts("timestamp")).alias("ts"),
        F.col("value_wei").cast("string").alias("value_wei"),
        F.col("tx_fee_wei").cast("string").alias("tx_fee_wei"),
        F.col("block_number").cast("bigint").alias("block_number"),
        F.col("contract_creation").cast("boolean").alias("contract_creation"),
        "tx_hash")


def with_window(edges: DataFrame, freq: str) -> DataFrame:
    return edges.withColumn(freq, window_label(freq))


def w_window_index(edges: DataFrame, freq: str) -> DataFrame:
    """Per window: first and last edge time, edge count."""
    return (with_window(edges, freq).groupBy(freq)
            .agg(F.min("ts").alias("window_min_ts"), F.max("ts").alias("window_end_ts"),
                 F.count(F.lit(1)).alias("edges_cnt"))
            .orderBy(freq))


def _window_nodes(edges: DataFrame, freq: str) -> DataFrame:
    e = with_window(edges, freq)
    return e.select(freq, F.explode(F.array("src_id", "dst_id")).alias("node_id")).where(F.col("node_id").isNotNull())


def w_window_nodes(edges: DataFrame, freq: str) -> DataFrame:
    """Distinct endpoints per window (a NULL receiver is not a node)."""
    return _window_nodes(edges, freq).groupBy(freq).agg(F.count_distinct("node_id").alias("nodes_cnt"))


def w_window_targets(edges: DataFrame, labels_map: DataFrame, freq: str) -> DataFrame:
    """(window, node_id) for labelled nodes active in the window."""
    nodes = _window_nodes(edges, freq).distinct()
    return nodes.join(labels_map.select("node_id").distinct(), "node_id", "left_semi").select(freq, "node_id")


def w_meta_join(index: DataFrame, nodes: DataFrame, freq: str) -> DataFrame:
    return index.join(nodes, freq, "left").select(freq, "window_min_ts", "window_end_ts", "edges_cnt",
                                                  "nodes_cnt").orderBy(freq)


def w_window_labels(edges: DataFrame) -> DataFrame:
    """(week, month) of every day with edges: both window lists from one pass."""
    days = edges.select(F.to_date(F.timestamp_seconds("ts")).alias("day")).where(F.col("day").isNotNull()).distinct()
    return days.select(iso_week("day").alias("week"), month_label("day").alias("month")).distinct()


def w_slices(edges: DataFrame, freq: str) -> DataFrame:
    """Edges tagged with their window: the rows of each slice file."""
    return with_window(edges, freq).select(freq, *EDGE_COLS)


def write_slices(edges: DataFrame, path: str, freq: str, rows_per_file: int | None = None,
                 row_group_bytes: int | None = None) -> DataFrame:
    """One directory per window (``month=…`` / ``week=…``); windows already there are skipped.

    A large window is split over several tasks and files.
    """
    return write_parts(w_slices(edges, freq), path, freq, rows_per_file, row_group_bytes)


# ---- series dataset ------------------------------------------------------------------
def s_daily_filtered(daily: DataFrame, address_map: DataFrame, until: str | None = None, day_text: bool = False) -> DataFrame:
    """Daily rows of mapped accounts only, with node id, ISO week and month; existing measures only.

    The map's part is hashed: days that come partitioned by the lower-cased address are neither
    shuffled nor sorted.  ``until``: a column of ``daily``, whose rows then stand for the idle days up to it as well;
    these are generated after the map was met, once per run.  ``day_text``: days as text."""
    measures = existing(daily, INT_COUNTS + ETH_NUMS)
    amap = (address_map.select(F.lower("address").alias("address"), "node_id")
            .groupBy("address").agg(F.min("node_id").alias("node_id")))
    d = daily.select(F.lower("address").alias("address"), F.col("day").cast("date").alias("day"), *measures, *([until] if until else []))
    j = d.join(amap.hint("shuffle_hash"), "address", "inner")
    if until:
        j = run_days(j, measures, until)
    return with_day_labels(j, day_text).select("node_id", "address", "day", "week", "month", *measures)


def series_aggs(df: DataFrame, from_text: bool = False, as_text: bool = True) -> list:
    cols = set(df.columns)
    out = []
    for c in sorted((set(INT_COUNTS) | set(ETH_NUMS)) & cols):
        if c in ETH_NUMS:
            src = F.col(c).cast("string") if from_text else F.col(c)
            v = F.sum(F.coalesce(src.try_cast("decimal(38,9)"), F.lit(0).cast("decimal(38,9)"))).cast("decimal(38,9)")
            out.append((v.cast("string") if as_text else v).alias(c))
        elif c in MAX_ONLY:
            out.append(F.max(F.coalesce(F.col(c).try_cast("bigint"), F.lit(0))).alias(c))
        else:
            out.append(F.sum(F.coalesce(F.col(c).try_cast("bigint"), F.lit(0))).alias(c))
    return out


def s_week_parts(daily_filtered: DataFrame) -> DataFrame:
    """One pass over the daily rows: exact partial sums per (node, week, month).

    A week straddling two months has two parts.  Both the weekly rollup and the
    week → month map are derived from this small table, so the daily table is
    read once.
    """
    return daily_filtered.groupBy("node_id", "week", "month").agg(*series_aggs(daily_filtered, as_text=False))


def s_weekly(daily_filtered: DataFrame, week_index: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Per (node, ISO week) for weeks of the graph index: counts summed, ETH sums as
    decimal(38,9) text, burst maximum; missing or bad values count as 0."""
    p = parts if parts is not None else daily_filtered        # one exchange, of partial sums per node and week
    # A week list is bounded by the calendar (about 53 rows per year): broadcast is safe.
    p = p.join(F.broadcast(week_index.select("week").distinct()), "week", "left_semi")
    return p.groupBy("node_id", "week").agg(*series_aggs(p))


def s_week_month_map(daily_filtered: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    src = parts if parts is not None else daily_filtered
    return src.select("week", "month").distinct()


def s_monthly(weekly: DataFrame, week_month: DataFrame, month_index: DataFrame) -> DataFrame:
    """Per (node, month) built from weeks: every week touching the month counts in full."""
    m = week_month.join(F.broadcast(month_index.select("month").distinct()), "month", "left_semi")
    j = weekly.join(F.broadcast(m), "week", "inner")
    return j.groupBy("node_id", "month").agg(*series_aggs(j, from_text=True))


def write_parts(df: DataFrame, path: str, window_col: str, rows_per_file: int | None = None,
                row_group_bytes: int | None = None, dealt: bool = False) -> DataFrame:
    """Resumable part files: windows that were committed are kept as they are, the others
    are added (filtered before ``df`` is computed); returns the whole table.  ``dealt``: a task
    of ``df`` has few windows, rows are written where they are.

    A window counts as there only when a commit names its files (see ``parts``); what a stopped run
    left of a window is written anew.
    """
    return add_missing_parts(df, path, window_col, dealt=dealt, maxRecordsPerFile=rows_per_file, **{"parquet.block.size": row_group_bytes})
