"""Registered graph-extraction queries (seed neighbourhoods) and their SQL oracles."""

from __future__ import annotations


from pyspark.sql import functions as F

from hopweave.operators import graph as g
from hopweave.plans.registry import AS_OF, CAP, K1, K2, portable, register
from hopweave.sources import fixtures as fx

FX = ["fx_transactions", "fx_seeds"]
MATERIALIZE = True  # checkpoint the ranked stages (tools/plan_report.py turns it off to show full plans)


def stages(spark, sf_dir, k1=K1, k2=K2, cap=CAP, scope="batch"):
    return g.build_graph(fx.transactions(spark, sf_dir), fx.seeds(spark, sf_dir), AS_OF, k1, k2, cap, scope=scope,
                         materialize=MATERIALIZE)


def first_hop(spark, sf_dir):
    """Only the first hop (no ranked stages are built or checkpointed)."""
    seeds = g.g_seeds(fx.seeds(spark, sf_dir), AS_OF)
    return g.g_first_hop(fx.transactions(spark, sf_dir), seeds)


# ---- SQL building blocks (DuckDB) -------------------------------------------
_TX = ("select lower(from_address) as from_address, lower(to_address) as to_address, block_number, "
       "block_timestamp as timestamp, value as value_wei_raw, gas_price as gas_price_wei, receipt_gas_used as gas_used, "
       "nonce, length(input) as input_length, hash as tx_hash, cast(block_timestamp as date) as day from fx_transactions")
_SEEDS = (f"select lower(address) as address, activity_start_ts as start_ts, "
          f"coalesce(activity_end_ts, TIMESTAMP '{AS_OF}') as end_ts from fx_seeds where activity_start_ts is not null")
_E1 = ("select t.*, s.address as seed_addr from g_tx t join g_seeds s on t.from_address = s.address "
       "and t.timestamp between s.start_ts and s.end_ts union all "
       "select t.*, s.address as seed_addr from g_tx t join g_seeds s on t.to_address = s.address "
       "and t.timestamp between s.start_ts and s.end_ts")
_L1 = (f"select seed_addr, neighbor_addr, day, sum_value_wei, last_ts from (select *, row_number() over ("
       f"partition by seed_addr, day order by sum_value_wei desc, last_ts desc, neighbor_addr asc nulls first) as rn from ("
       f"select seed_addr, case when from_address = seed_addr then to_address else from_address end as neighbor_addr, day, "
       f"sum(value_wei_raw) as sum_value_wei, max(timestamp) as last_ts from g_e1 group by all)) where rn <= {K1}")
_TXD = "select * from g_tx where day in (select day from g_l1)"
_IDX = ("select distinct day, from_address as addr, tx_hash from g_txd union all "
        "select distinct day, to_address as addr, tx_hash from g_txd")
_BATCH = "cast(floor((CAST('0x' || substr(md5(neighbor_addr), 1, 15) AS BIGINT) % 64) / 4) as int)"


#: Every first-hop neighbour, unranked.
_L1_ALL = "select distinct seed_addr, case when from_address = seed_addr then to_address else from_address end as neighbor_addr, day from g_e1"


def _l2(k, batch=True):
    b = _BATCH if batch else "0"
    return (f"select seed_addr, neighbor2_addr, day, sum_value_wei, last_ts, tx_cnt from (select *, row_number() over ("
            f"partition by seed_addr, day, b order by sum_value_wei desc, last_ts desc, neighbor2_addr asc nulls first) as rn from ("
            f"select h.seed_addr, h.b, case when t.from_address = h.neighbor_addr then t.to_address else t.from_address end as neighbor2_addr, "
            f"t.day, sum(t.value_wei_raw) as sum_value_wei, max(t.timestamp) as last_ts, count(*) as tx_cnt "
            f"from g_txd t join (select i.day, i.tx_hash, l.seed_addr, l.neighbor_addr, l.b from g_idx i join "
            f"(select seed_addr, neighbor_addr, day, {b} as b from g_l1) l on i.day = l.day and i.addr = l.neighbor_addr) h "
            f"on t.day = h.day and t.tx_hash = h.tx_hash group by all)) where rn <= {k}")


def _e2(direction, cap):
    near, far = ("from_address", "to_address") if direction == "out" else ("to_address", "from_address")
    return (f"select from_address, to_address, block_number, timestamp, value_wei_raw, gas_price_wei, gas_used, nonce, "
            f"input_length, tx_hash, day from (select t.*, row_number() over (partition by l1.seed_addr, t.day, t.{near}, t.{far} "
            f"order by t.value_wei_raw desc, t.block_number desc, t.tx_hash asc nulls first) as rn "
            f"from g_txd t join g_l1 l1 on l1.day = t.day and t.{near} = l1.neighbor_addr "
            f"join g_l2 l2 on l2.day = t.day and l2.seed_addr = l1.seed_addr and l2.neighbor2_addr = t.{far} "
            f"where t.value_wei_raw >= 100000000000000) where rn <= {cap}")


_E1D = ("select from_address, to_address, block_number, timestamp, value_wei_raw, gas_price_wei, gas_used, nonce, "
        "input_length, tx_hash, day from g_e1 where value_wei_raw >= 100000000000000")
_FINAL = f"{_E1D} union all {_e2('out', CAP)} union all {_e2('in', CAP)}"
_FEAT = ("select any_value(lower(from_address)) as from_address, any_value(lower(to_address)) as to_address, "
         "any_value(block_number) as block_number, any_value(timestamp) as timestamp, "
         "cast(cast(any_value(value_wei_raw) as decimal(38,0)) as varchar) as value_wei, "
         "cast(cast(any_value(gas_price_wei) as decimal(38,0)) * cast(any_value(gas_used) as decimal(38,0)) as varchar) as tx_fee_wei, "
         "any_value(nonce) as nonce, "
         "cast(case when any_value(input_length) is null then null else floor(greatest(any_value(input_length) - 2, 0) / 2) end as bigint) as input_data_size, "
         "any_value(to_address) is null as contract_creation, tx_hash, cast(day as varchar) as day "
         "from g_final group by tx_hash, day")

_TXC = ("from_address, to_address, block_number, timestamp, cast(value_wei_raw as varchar) as value_wei_raw, "
        "gas_price_wei, gas_used, nonce, input_length, tx_hash, cast(day as varchar) as day")


def _with(*parts, l1=_L1):
    names = {"g_tx": _TX, "g_seeds": _SEEDS, "g_e1": _E1, "g_l1": l1, "g_txd": _TXD, "g_idx": _IDX,
             "g_l2": _l2(K2), "g_final": _FINAL}
    return "WITH " + ", ".join(f"{p} AS ({names[p]})" for p in parts) + " "


_ALL = ("g_tx", "g_seeds", "g_e1", "g_l1", "g_txd", "g_idx", "g_l2")


@register("g_seeds", sql=f"select address, start_ts, end_ts from ({_SEEDS})", fixtures=FX)
def q_seeds(spark, sf_dir):
    """Seeds: lower-cased address with an activity window, open end → as_of."""
    return g.g_seeds(fx.seeds(spark, sf_dir), AS_OF)


@register("g_first_hop", sql=_with("g_tx", "g_seeds", "g_e1") + f"select {_TXC}, seed_addr from g_e1", fixtures=FX)
def q_first_hop(spark, sf_dir):
    """Interval join of the ledger with seed windows, both sides."""
    return first_hop(spark, sf_dir)


@register("g_counterparty", sql=_with("g_tx", "g_seeds", "g_e1") +
          "select seed_addr, cast(day as varchar) as day, case when from_address = seed_addr then to_address "
          "else from_address end as neighbor_addr, cast(value_wei_raw as varchar) as value_wei_raw, timestamp, tx_hash from g_e1",
          fixtures=FX)
def q_counterparty(spark, sf_dir):
    """The other side of each first-hop edge."""
    return g.g_counterparty(first_hop(spark, sf_dir))


@register("g_l1_topk", sql=_with("g_tx", "g_seeds", "g_e1", "g_l1") +
          "select seed_addr, neighbor_addr, cast(day as varchar) as day, cast(sum_value_wei as varchar) as sum_value_wei, last_ts from g_l1",
          fixtures=FX)
def q_l1_topk(spark, sf_dir):
    """Top-k first-hop neighbours per (seed, day) by wei, recency, address."""
    return stages(spark, sf_dir)["l1"]


@register("g_active_days_filter", sql=_with("g_tx", "g_seeds", "g_e1", "g_l1", "g_txd") + f"select {_TXC} from g_txd",
          fixtures=FX)
def q_active_days(spark, sf_dir):
    """Ledger rows on days that have first-hop neighbours."""
    return stages(spark, sf_dir)["txd"]


@register("g_addr_day_index", sql=_with("g_tx", "g_seeds", "g_e1", "g_l1", "g_txd", "g_idx") +
          "select cast(day as varchar) as day, addr, tx_hash from g_idx", fixtures=FX)
def q_index(spark, sf_dir):
    """(day, address, tx) index over both sides."""
    return g.g_addr_day_index(stages(spark, sf_dir)["txd"])


_L2OUT = ("select seed_addr, neighbor2_addr, cast(day as varchar) as day, cast(sum_value_wei as varchar) as sum_value_wei, "
          "last_ts, tx_cnt from g_l2")


@register("g_l2_topk", sql=_with(*_ALL) + _L2OUT, fixtures=FX)
def q_l2_topk(spark, sf_dir):
    """Second-hop top-k inside each of 16 hash batches of first-hop neighbours."""
    return stages(spark, sf_dir)["l2"]


@register("g_l2_topk_global", sql=_with(*_ALL[:-1]).rstrip() + f", g_l2 AS ({_l2(K2, batch=False)}) " + _L2OUT,
          fixtures=FX)
def q_l2_topk_global(spark, sf_dir):
    """Exact second-hop top-k per (seed, day)."""
    return stages(spark, sf_dir, scope="global")["l2"]


@register("g_two_hop_raw", sql=_with("g_tx", "g_seeds", "g_e1", "g_l1", "g_txd", "g_idx", l1=_L1_ALL) +
          "select t.from_address, t.to_address, t.block_number, t.timestamp, cast(t.value_wei_raw as varchar) as value_wei_raw, "
          "t.gas_price_wei, t.gas_used, t.nonce, t.input_length, t.tx_hash, cast(t.day as varchar) as day, h.seed_addr "
          "from g_txd t join (select i.day, i.tx_hash, l.seed_addr from g_idx i join g_l1 l on i.day = l.day "
          "and i.addr = l.neighbor_addr) h on t.day = h.day and t.tx_hash = h.tx_hash", fixtures=FX)
def q_two_hop_raw(spark, sf_dir):
    """All transfers of all first-hop neighbours on their day, tagged with the seed.

    A transfer comes out once per seed, so days and amounts become text before, once per transfer."""
    s = stages(spark, sf_dir, k1=None)
    return g.g_two_hop_raw(portable(s["txd"]), portable(s["l1"]))


@register("g_frontier", sql=_with(*_ALL) +
          "select seed_addr, cast(day as varchar) as day, neighbor_addr as addr from g_l1 union all "
          "select seed_addr, cast(day as varchar) as day, neighbor2_addr as addr from g_l2", fixtures=FX)
def q_frontier(spark, sf_dir):
    """First- and second-hop addresses per (seed, day)."""
    s = stages(spark, sf_dir)
    return g.g_frontier(s["l1"], s["l2"])


@register("g_e1_dust", sql=_with("g_tx", "g_seeds", "g_e1") + f"select {_TXC} from g_e1 where value_wei_raw >= 100000000000000",
          fixtures=FX)
def q_e1_dust(spark, sf_dir):
    """First-hop edges at or above the dust threshold."""
    return g.g_e1_dust(first_hop(spark, sf_dir))


@register("g_e2_out", sql=_with(*_ALL) + f"select {_TXC} from ({_e2('out', CAP)})", fixtures=FX)
def q_e2_out(spark, sf_dir):
    """First-hop → second-hop transfers, capped per (seed, day, pair)."""
    s = stages(spark, sf_dir)
    return g.g_e2_out(s["txd"], s["l1"], s["l2"], CAP)


@register("g_e2_in", sql=_with(*_ALL) + f"select {_TXC} from ({_e2('in', CAP)})", fixtures=FX)
def q_e2_in(spark, sf_dir):
    """Second-hop → first-hop transfers, capped per (seed, day, pair)."""
    s = stages(spark, sf_dir)
    return g.g_e2_in(s["txd"], s["l1"], s["l2"], CAP)


@register("g_final_tx", sql=_with(*_ALL, "g_final") + f"select {_TXC} from g_final", fixtures=FX)
def q_final_tx(spark, sf_dir):
    """E1 ∪ E2-out ∪ E2-in."""
    s = stages(spark, sf_dir)
    return g.g_final_tx(s["e1"], s["txd"], s["l1"], s["l2"], CAP, sides=s["sides"])


@register("g_edge_features", sql=_with(*_ALL, "g_final") + _FEAT, fixtures=FX)
def q_edge_features(spark, sf_dir):
    """Deduplicated daily edges with exact value/fee, input size and creation flag."""
    s = stages(spark, sf_dir)
    return g.g_edge_features(g.g_final_tx(s["e1"], s["txd"], s["l1"], s["l2"], CAP, sides=s["sides"]))


@register("g_append_final", sql=_with(*_ALL, "g_final") + _FEAT, fixtures=FX)
def q_append_final(spark, sf_dir):
    """Daily edges appended in two overlapping batches, the second replayed; read back."""
    from hopweave.session import cut_lineage, stage_path
    s = stages(spark, sf_dir)
    edges = g.g_edge_features(g.g_final_tx(s["e1"], s["txd"], s["l1"], s["l2"], CAP, sides=s["sides"]))
    edges, path = cut_lineage(edges), stage_path(spark, "transactions_daily")
    part = F.pmod(F.xxhash64("tx_hash"), F.lit(3))
    g.g_append_final(edges.where(part < 2), path)
    g.g_append_final(edges.where(part > 0), path)
    return g.g_append_final(edges.where(part > 0), path)


@register("g_clustered_stage", sql="WITH g_tx AS (" + _TX + """), gaps AS (select from_address as address, value_wei_raw,
  epoch_us(timestamp) - epoch_us(lag(timestamp) over (partition by from_address order by timestamp)) as gap_us
  from g_tx where from_address is not null)
select lower(s.address) as address, count(*) as sent_cnt, cast(sum(value_wei_raw) as varchar) as sum_value_wei, max(gap_us) as longest_gap_us
from gaps g join fx_seeds s on lower(s.address) = g.address group by 1""", fixtures=FX)
def q_clustered_stage(spark, sf_dir):
    """Transfers and seeds stored clustered by address, then joined and windowed bucket by bucket:
    transfers each seed sent, their value and the longest pause between two."""
    import uuid

    from pyspark.sql import Window

    from hopweave.operators import clustered as c
    run, seeds = uuid.uuid4().hex, fx.seeds(spark, sf_dir).select(F.lower("address").alias("address"))
    sent = g.normalize_tx(fx.transactions(spark, sf_dir)).where("from_address is not null") \
        .select(F.col("from_address").alias("address"), "timestamp", "value_wei_raw")
    buckets = c.buckets_for(sent.count())
    moves = c.write_clustered(sent, f"sent_{run}", ["address"], buckets, sort=["address", "timestamp"])
    who = c.write_clustered(seeds, f"seeds_{run}", ["address"], buckets)
    micros = F.unix_micros("timestamp")
    gap = micros - F.lag(micros).over(Window.partitionBy("address").orderBy("timestamp"))
    return moves.withColumn("gap", gap).join(who, "address").groupBy("address").agg(
        F.count(F.lit(1)).alias("sent_cnt"), F.sum("value_wei_raw").cast("decimal(38,0)").alias("sum_value_wei"), F.max("gap").alias("longest_gap_us"))
