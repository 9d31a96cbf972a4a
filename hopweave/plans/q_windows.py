"""Registered window-dataset queries (graph slices, series rollups) and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from hopweave.operators import series
from hopweave.operators import windows as w
from hopweave.plans.registry import register
from hopweave.session import cut_lineage, stage_path
from hopweave.sources import fixtures as fx

FX = ["fx_accounts", "fx_window_edges", "fx_order_calendar"]
_H = "CAST('0x' || substr(md5({x}), 1, 15) AS BIGINT)"


def _nid(c):
    return f"case when {c} is null then null else {_H.format(x='lower(' + c + ')')} end"


CTE = (
    f"WITH lab AS (select {_nid('address')} as node_id, cast(is_scam as bigint) as is_scam, "
    "cast(is_contract as bigint) as is_contract, address, lower(address) as address_lc from fx_accounts), "
    f"ed AS (select {_nid('from_address')} as src_id, {_nid('to_address')} as dst_id, epoch_us(timestamp) // 1000000 as ts, "
    "cast(value_wei as varchar) as value_wei, cast(tx_fee_wei as varchar) as tx_fee_wei, block_number, contract_creation, "
    "tx_hash from fx_window_edges), "
    "edw AS (select *, strftime(make_timestamp(ts * 1000000), '%Y-%m') as month, "
    "strftime(make_timestamp(ts * 1000000), '%G-W%V') as week from ed), "
    "nd AS (select month, week, n from (select month, week, src_id as n from edw union all "
    "select month, week, dst_id from edw) where n is not null), "
    "idx_month AS (select month, min(ts) as window_min_ts, max(ts) as window_end_ts, count(*) as edges_cnt from edw group by month), "
    "idx_week AS (select week, min(ts) as window_min_ts, max(ts) as window_end_ts, count(*) as edges_cnt from edw group by week), "
    "nodes_month AS (select month, count(distinct n) as nodes_cnt from nd group by month), "
    "nodes_week AS (select week, count(distinct n) as nodes_cnt from nd group by week), "
    "df AS (select m.node_id, c.address, c.day, strftime(c.day, '%G-W%V') as week, strftime(c.day, '%Y-%m') as month, "
    "c.normal_total_cnt, c.erc20_total_cnt, c.internal_in_cnt, c.internal_out_cnt, c.eth_recv_sum "
    "from fx_order_calendar c join (select lower(address) as address, min(node_id) as node_id from lab group by 1) m "
    "on lower(c.address) = m.address), "
    "wk AS (select node_id, week, cast(sum(coalesce(normal_total_cnt, 0)) as bigint) as normal_total_cnt, "
    "cast(sum(coalesce(erc20_total_cnt, 0)) as bigint) as erc20_total_cnt, "
    "cast(sum(coalesce(internal_in_cnt, 0)) as bigint) as internal_in_cnt, "
    "cast(sum(coalesce(internal_out_cnt, 0)) as bigint) as internal_out_cnt, "
    "cast(sum(coalesce(try_cast(eth_recv_sum as decimal(38,9)), 0)) as varchar) as eth_recv_sum "
    "from df where week in (select week from idx_week) group by node_id, week), "
    "wm AS (select distinct week, month from df), "
    "mo AS (select k.node_id, m.month, cast(sum(coalesce(normal_total_cnt, 0)) as bigint) as normal_total_cnt, "
    "cast(sum(coalesce(erc20_total_cnt, 0)) as bigint) as erc20_total_cnt, "
    "cast(sum(coalesce(internal_in_cnt, 0)) as bigint) as internal_in_cnt, "
    "cast(sum(coalesce(internal_out_cnt, 0)) as bigint) as internal_out_cnt, "
    "cast(sum(coalesce(try_cast(eth_recv_sum as decimal(38,9)), 0)) as varchar) as eth_recv_sum "
    "from wk k join wm m on k.week = m.week where m.month in (select month from idx_month) group by k.node_id, m.month) "
)


def edges(spark, sf_dir):
    return w.w_edges(fx.window_edges(spark, sf_dir))


def labels(spark, sf_dir):
    return w.w_labels_map(fx.accounts(spark, sf_dir))


@register("w_labels_map", sql=CTE + "select node_id, is_scam, is_contract, address from lab", fixtures=FX)
def q_labels(spark, sf_dir):
    """Global targets: node id of the lower-cased address, int8 labels, one row per node."""
    return w.w_targets_global(labels(spark, sf_dir))


@register("w_address_map", sql=CTE + "select address, node_id from lab", fixtures=FX)
def q_map(spark, sf_dir):
    """(address, node_id) map of labelled accounts."""
    return w.w_address_map(labels(spark, sf_dir))


@register("w_edges", sql=CTE + "select * from ed", fixtures=FX)
def q_edges(spark, sf_dir):
    """Edges with hashed endpoints, unix seconds, wei amounts as text."""
    return edges(spark, sf_dir)


for _f in ("month", "week"):
    sfx = "" if _f == "month" else "_week"

    def _mk(freq):
        @register(f"w_window_index{sfx}", sql=CTE + f"select * from idx_{freq}", fixtures=FX)
        def q_index(spark, sf_dir):
            return w.w_window_index(edges(spark, sf_dir), freq)

        @register(f"w_window_nodes{sfx}", sql=CTE + f"select * from nodes_{freq}", fixtures=FX)
        def q_nodes(spark, sf_dir):
            return w.w_window_nodes(edges(spark, sf_dir), freq)

        @register(f"w_window_targets{sfx}", sql=CTE + f"select distinct {freq}, n as node_id from nd "
                  f"where n in (select node_id from lab)", fixtures=FX)
        def q_targets(spark, sf_dir):
            return w.w_window_targets(edges(spark, sf_dir), labels(spark, sf_dir), freq)

        @register(f"w_meta_join{sfx}", sql=CTE + f"select i.{freq}, window_min_ts, window_end_ts, edges_cnt, nodes_cnt "
                  f"from idx_{freq} i left join nodes_{freq} n using ({freq})", fixtures=FX)
        def q_meta(spark, sf_dir):
            e = edges(spark, sf_dir)
            return w.w_meta_join(w.w_window_index(e, freq), w.w_window_nodes(e, freq), freq)

        @register(f"w_slices{sfx}", sql=CTE + f"select {freq}, src_id, dst_id, ts, value_wei, tx_fee_wei, block_number, "
                  f"contract_creation, tx_hash from edw", fixtures=FX)
        def q_slices(spark, sf_dir):
            return w.w_slices(edges(spark, sf_dir), freq)

        @register(f"w_slices_stored{sfx}", sql=CTE + f"select {freq}, src_id, dst_id, ts, value_wei, tx_fee_wei, block_number, "
                  f"contract_creation, tx_hash from edw", fixtures=FX)
        def q_slices_stored(spark, sf_dir):
            """Slices written as one committed folder per window and read back."""
            return w.write_slices(edges(spark, sf_dir), stage_path(spark, f"slices_{freq}"), freq)

    _mk(_f)


def daily_filtered(spark, sf_dir, day_text=False):
    runs = fx.order_runs(spark, sf_dir, by=F.lower("address"))
    return w.s_daily_filtered(runs, w.w_address_map(labels(spark, sf_dir)), until="until", day_text=day_text)


@register("s_daily_filtered", sql=CTE + "select node_id, address, cast(day as varchar) as day, week, month, normal_total_cnt, "
          "erc20_total_cnt, internal_in_cnt, internal_out_cnt, floor(eth_recv_sum * 1e6 + 0.5) / 1e6 as eth_recv_sum from df",
          fixtures=FX)
def q_daily_filtered(spark, sf_dir):
    """Daily rows of mapped accounts with node id, ISO week and month."""
    return daily_filtered(spark, sf_dir, day_text=True)


def mapped_series(spark, sf_dir):
    """Sparse days and spans of mapped accounts."""
    return series.mapped(fx.order_days(spark, sf_dir), fx.order_spans(spark, sf_dir), w.w_address_map(labels(spark, sf_dir)))


def weekly(spark, sf_dir):
    return series.weekly(*mapped_series(spark, sf_dir), w.w_window_labels(edges(spark, sf_dir)))


@register("s_weekly", sql=CTE + "select * from wk", fixtures=FX)
def q_weekly(spark, sf_dir):
    """Weekly rollup on the graph's weeks (decimal ETH sums as text)."""
    return weekly(spark, sf_dir)


@register("s_weekly_dense", sql=CTE + "select * from wk", fixtures=FX)
def q_weekly_dense(spark, sf_dir):
    """Weekly rollup of a dense daily table."""
    return w.s_weekly(daily_filtered(spark, sf_dir), w.w_window_index(edges(spark, sf_dir), "week"))


@register("s_week_month_map", sql=CTE + "select * from wm", fixtures=FX)
def q_week_month(spark, sf_dir):
    """Distinct (ISO week, month) pairs of the days of all spans."""
    return series.week_month_map(mapped_series(spark, sf_dir)[1])


@register("s_monthly", sql=CTE + "select * from mo", fixtures=FX)
def q_monthly(spark, sf_dir):
    """Monthly rollup built from whole weeks (a straddling week counts in both months)."""
    labels_of = cut_lineage(w.w_window_labels(edges(spark, sf_dir)))
    return series.monthly(*mapped_series(spark, sf_dir), labels_of, labels_of)


#: Nodes whose weeks of a block one task writes (a file per week).
NODES_A_SHARE = 250_000


@register("s_resume_parts", sql=CTE + "select * from wk", fixtures=FX)
def q_resume_parts(spark, sf_dir):
    """Weekly parts: half of the weeks written, then the rest by a second run that skips those, read back."""
    path = stage_path(spark, "weekly_parts")
    index = cut_lineage(w.w_window_labels(edges(spark, sf_dir)))
    rows = series.weekly(*mapped_series(spark, sf_dir), index, nodes_a_share=NODES_A_SHARE)
    w.write_parts(rows.where(F.substring("week", 7, 2).cast("int") % 2 == 0), path, "week", dealt=True)
    return w.write_parts(rows, path, "week", dealt=True)
