"""Seed-centred transfer neighbourhoods: first hop, ranked neighbours, second hop, edges.

Scale notes
-----------
* The ledger is never shuffled for the first hop: each transfer is exploded to
  its two endpoints and probed against the seed list, which is broadcast only
  after a row count proves it small (``sized_broadcast``); beyond the bound
  Spark plans a shuffle join.
* Top-k per (seed, day) is ``row_number() <= k``.  Spark plans it with a
  partial ``WindowGroupLimit`` before the window's shuffle, so a hub seed with a
  huge neighbour list sends at most k rows per map task.
* Every ``groupBy`` is partially aggregated map-side, so hot addresses collapse
  before the shuffle.
* The second hop probes the day-restricted ledger once, on (day, endpoint),
  instead of index-then-lookup: sides are tested against bit pages of the wanted
  keys where the ledger is read, and only those that pass are shuffled to the exact
  join; AQE splits a skewed (day, hub) partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopweave.functions.common import DUST_WEI, as_of_ts, hash_shard, sized_broadcast, strict_greatest, utc_ts
from hopweave.functions.membership import probable_members
from hopweave.operators.daily import Stages
from hopweave.session import path_exists

TX_COLS = ["from_address", "to_address", "block_number", "timestamp", "value_wei_raw",
           "gas_price_wei", "gas_used", "nonce", "input_length", "tx_hash", "day"]

# Seeds and day lists are broadcast below these proven row counts.
SEED_BROADCAST_ROWS = 200_000
DAYS_BROADCAST_ROWS = 100_000


def normalize_tx(tx: DataFrame) -> DataFrame:
    """Raw ledger rows → lower-cased endpoints, UTC timestamp, day; wei amounts kept exact."""
    ts = utc_ts("block_timestamp")
    return tx.select(
        F.lower("from_address").alias("from_address"),
        F.lower("to_address").alias("to_address"),
        F.col("block_number").cast("bigint").alias("block_number"),
        ts.alias("timestamp"),
        F.col("value").alias("value_wei_raw"),
        F.col("gas_price").alias("gas_price_wei"),
        F.col("receipt_gas_used").cast("bigint").alias("gas_used"),
        F.col("nonce").cast("bigint").alias("nonce"),
        F.length("input").cast("bigint").alias("input_length"),  # the calldata itself is never shuffled
        F.col("hash").alias("tx_hash"),
        F.to_date(ts).alias("day"),
    )


def g_seeds(accounts: DataFrame, as_of, shard: tuple | None = None) -> DataFrame:
    """Seeds with an activity window; an open end becomes ``as_of``.

    ``shard=(n, lo, hi)`` keeps only seeds whose stable hash mod n is in [lo, hi].
    """
    out = accounts.where(F.col("activity_start_ts").isNotNull()).select(
        F.lower("address").alias("address"),
        utc_ts("activity_start_ts").alias("start_ts"),
        F.coalesce(utc_ts("activity_end_ts"), as_of_ts(as_of)).alias("end_ts"))
    if shard is not None:
        n, lo, hi = shard
        out = out.where(hash_shard("address", n).between(lo, hi))
    return out


def seed_window(seeds: DataFrame) -> dict:
    """One pass over the seed list: row count and overall [start, end] (three scalars)."""
    r = seeds.agg(F.count(F.lit(1)).alias("n"), F.min("start_ts").alias("lo"), F.max("end_ts").alias("hi")).first()
    return {"n": int(r["n"]), "lo": r["lo"], "hi": r["hi"]}


def g_first_hop(tx: DataFrame, seeds: DataFrame, window: dict | None = None) -> DataFrame:
    """Transfers with a seed on either side inside the seed's window (inclusive).

    A self-transfer of a seed yields two rows (one per side), as a UNION ALL of
    the sender and receiver joins would.  The overall seed window is pushed into
    the ledger scan as a timestamp range; the seed list is broadcast when its
    counted size is under ``SEED_BROADCAST_ROWS``.
    """
    window = window or seed_window(seeds)
    t = normalize_tx(tx)
    s = seeds.select(F.col("address").alias("seed_addr"), "start_ts", "end_ts")
    if window["lo"] is None:
        t = t.where(F.lit(False))
    else:
        t = t.where(F.col("timestamp").between(F.lit(window["lo"]), F.lit(window["hi"])))
    ends = t.select(*TX_COLS, F.explode(F.array("from_address", "to_address")).alias("endpoint"))
    if window["n"] <= SEED_BROADCAST_ROWS:
        s = F.broadcast(s)
    j = ends.join(s, (ends.endpoint == s.seed_addr)
                  & ends.timestamp.between(s.start_ts, s.end_ts), "inner")
    return j.select(*TX_COLS, "seed_addr")


def counterparty(seed_col="seed_addr") -> Column:
    """The other side of an edge relative to the seed (NULL receiver on contract creation)."""
    return F.when(F.col("from_address") == F.col(seed_col), F.col("to_address")).otherwise(F.col("from_address"))


def g_counterparty(e1: DataFrame) -> DataFrame:
    return e1.select("seed_addr", "day", counterparty().alias("neighbor_addr"), "value_wei_raw", "timestamp", "tx_hash")


def top_k(df: DataFrame, partition: list, order: list, k: int) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def g_l1_topk(e1: DataFrame, k: int | None = 15) -> DataFrame:
    """Per (seed, neighbour, day): total wei and last time; keep k per (seed, day), all without ``k``."""
    scored = (g_counterparty(e1)
              .groupBy("seed_addr", "neighbor_addr", "day")
              .agg(F.sum("value_wei_raw").alias("sum_value_wei"), F.max("timestamp").alias("last_ts")))
    ranked = scored if k is None else top_k(scored, ["seed_addr", "day"],
                                            [F.desc_nulls_last("sum_value_wei"), F.desc_nulls_last("last_ts"),
                                             F.asc_nulls_first("neighbor_addr")], k)
    return ranked.select("seed_addr", "neighbor_addr", "day", "sum_value_wei", "last_ts")


def g_active_days_filter(tx: DataFrame, l1: DataFrame, window: dict | None = None) -> DataFrame:
    """Ledger rows only on days that have first-hop neighbours (semi join on the day list).

    The day list is bounded by the span of the seed window (``window``, or the
    span of ``l1`` computed in one pass), which also prunes the ledger scan;
    within the bound it is broadcast without counting it.
    """
    t = normalize_tx(tx)
    if window is not None and window["lo"] is not None:
        lo, hi = window["lo"].date(), window["hi"].date()
    else:
        r = l1.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
        lo, hi = r["lo"], r["hi"]
    if lo is None:
        return t.where(F.lit(False))
    t = t.where(F.col("day").between(F.lit(lo), F.lit(hi)))
    days = l1.select("day").distinct()
    if (hi - lo).days + 1 <= DAYS_BROADCAST_ROWS:
        days = F.broadcast(days)
    return t.join(days, "day", "left_semi")


def g_addr_day_index(tx_days: DataFrame) -> DataFrame:
    """(day, addr, tx_hash) for both sides; distinct within each side."""
    a = tx_days.select("day", F.col("from_address").alias("addr"), "tx_hash").distinct()
    b = tx_days.select("day", F.col("to_address").alias("addr"), "tx_hash").distinct()
    return a.unionByName(b)


#: What the second-hop ranking reads of a transfer.
RANK_COLS = ["day", "value_wei_raw", "timestamp"]


def wanted_sides(l1: DataFrame) -> DataFrame:
    """(day, near): the first-hop neighbours of every day."""
    return l1.select("day", F.col("neighbor_addr").alias("near")).where(F.col("near").isNotNull()).distinct()


def probable_sides(tx_days: DataFrame, wanted: DataFrame, columns=TX_COLS) -> DataFrame:
    """Each transfer once per side that is in all probability in ``wanted`` (none is missed).

    The sides are tested where the ledger is read, against bit pages of the wanted (day,
    neighbour) keys; only those that pass go on to the exact join.
    """
    sides = F.array(
        F.struct(F.lit("out").alias("dir"), F.col("from_address").alias("near"), F.col("to_address").alias("far")),
        F.struct(F.lit("in").alias("dir"), F.col("to_address").alias("near"), F.col("from_address").alias("far")))
    rows = tx_days.select(*columns, F.explode(sides).alias("s")).select(*columns, "s.dir", "s.near", "s.far").where(F.col("near").isNotNull())
    return probable_members(rows, wanted, ["day", "near"])


def near_sides(tx_days: DataFrame, l1: DataFrame, columns=TX_COLS) -> DataFrame:
    """Each transfer once per side that is a first-hop neighbour of that day, as (near, far, dir),
    with the transfer's ``columns``."""
    wanted = wanted_sides(l1)
    return probable_sides(tx_days, wanted, columns).join(wanted, ["day", "near"], "left_semi").select(*columns, "dir", "near", "far")


def l1_batch(col="neighbor_addr", n_shards: int = 64, per_batch: int = 4) -> Column:
    return F.floor(hash_shard(col, n_shards) / per_batch).cast("int")


def g_l2_topk(tx_days: DataFrame, l1: DataFrame, k: int = 5, scope: str = "batch",
              n_shards: int = 64, per_batch: int = 4, sides: DataFrame | None = None) -> DataFrame:
    """Second-hop neighbours of each (seed, day), ranked by wei, recency, address.

    ``scope="global"``: exact top-k per (seed, day).  ``scope="batch"``: the
    source pipeline's semantics — first-hop neighbours are split into
    ``n_shards / per_batch`` hash batches and sums and top-k are taken inside
    each batch, so a second-hop address may appear once per batch with a
    partial sum.

    Transfers are first summed per (day, near, far).  The ranking depends only on the set of a
    seed's first-hop neighbours, so it is made once per distinct set (see ``top_of_sets``) and a
    hub's counterparties never meet all the seeds that list the hub.  ``sides``: ``near_sides``
    if already kept.
    """
    l1k = l1.where(F.col("neighbor_addr").isNotNull()).select("seed_addr", "neighbor_addr", "day")
    keys = ["seed_addr", "day"]
    if scope == "batch":
        l1k = l1k.withColumn("l1_batch", l1_batch("neighbor_addr", n_shards, per_batch))
        keys = keys + ["l1_batch"]
    elif scope != "global":
        raise ValueError(f"unknown scope {scope!r}")
    sides = near_sides(tx_days, l1, RANK_COLS) if sides is None else sides
    pairs = sides.groupBy("day", "near", "far").agg(F.sum("value_wei_raw").alias("wei"), F.max("timestamp").alias("ts"), F.count(F.lit(1)).alias("n"))
    sets = l1k.groupBy(*keys).agg(F.sort_array(F.collect_list("neighbor_addr")).alias("nears"))      # what ranks first of a seed's day
    ranked = top_of_sets(pairs, sets.select("day", "nears").distinct(), k)
    return sets.join(ranked, ["day", "nears"]).select("seed_addr", "neighbor2_addr", "day", "sum_value_wei", "last_ts", "tx_cnt")


#: A far address with at most this many nears a day is matched with all pairs of its nears, one
#: with more only with the pairs that a set holds.
FAR_NEARS = 64


def _both_nears(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(day, a, b, far_key, most, of_a, of_b): the far addresses that two nears a < b of a day
    have in common, at least for the ``wanted`` (day, a, b)."""
    def side(df, near):
        return df.select("day", "far_key", F.col("near").alias(near), F.struct("wei", "ts", "n").alias(f"of_{near}"), *(["most"] if near == "a" else []))
    few, many = pairs.where(F.col("nears_cnt").between(2, FAR_NEARS)), pairs.where(F.col("nears_cnt") > FAR_NEARS)
    light = side(few, "a").join(side(few, "b"), ["day", "far_key"]).where(F.col("a") < F.col("b"))
    heavy = wanted.join(side(many, "a"), ["day", "a"]).join(side(many, "b"), ["day", "b", "far_key"])
    cols = ["day", "a", "b", "far_key", "most", "of_a", "of_b"]
    return light.select(*cols).unionByName(heavy.select(*cols))


def top_of_sets(pairs: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """The ``k`` best far addresses of every (day, nears) of ``sets``, ranked by the sum of wei over
    the nears (one listed twice counts twice), recency and address.

    ``pairs``: one row per (day, near, far) with wei, ts and n.  Exact, without a row per set and
    far address: a far address with one near of a set is outranked by ``k`` others if it is by
    ``k`` of that near's, so the first ``k`` of every near do, beside those that several nears of
    the set have in common.  Of these, one whose wei over all nears of the day is below the k-th
    largest single amount of the set cannot rank.  An address with a negative amount outranks
    nobody for certain: it is always scored and never the reason to leave one out.
    """
    pairs = pairs.select("day", "near", F.struct("far").alias("far_key"), "wei", "ts", "n")      # a null far is an address like any other
    of_far = pairs.groupBy("day", "far_key").agg(F.count(F.lit(1)).alias("nears_cnt"), F.try_sum(F.greatest("wei", F.lit(0))).alias("most"),
                                                 F.coalesce(F.min("wei") >= 0, F.lit(True)).alias("sure"))
    pairs = pairs.join(of_far, ["day", "far_key"])
    order = [F.desc_nulls_last("wei"), F.desc_nulls_last("ts"), F.asc_nulls_first("far_key")]
    firsts = top_k(pairs.where("sure"), ["day", "near"], order, k).unionByName(pairs.where(~F.col("sure")))
    distinct = F.array_distinct("nears")
    own = sets.select("day", "nears", F.explode(distinct).alias("near")).join(firsts, ["day", "near"])

    several = sets.where(F.size(distinct) > 1)
    single = own.where("sure").groupBy("day", "nears", "far_key").agg(F.max("wei").alias("wei"))
    least = single.groupBy("day", "nears").agg(F.get(F.sort_array(F.collect_list("wei"), asc=False), F.lit(k - 1)).alias("least"))
    twos = F.flatten(F.transform(distinct, lambda a: F.transform(F.filter(distinct, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    twos = several.join(least, ["day", "nears"], "left").select("day", "nears", "least", F.explode(twos).alias("two")) \
        .select("day", "nears", "least", "two.a", "two.b")
    below = (F.size("nears") == F.size(distinct)) & (F.col("most") < F.col("least"))
    both = twos.join(_both_nears(pairs, twos.select("day", "a", "b").distinct()), ["day", "a", "b"]).where(~F.coalesce(below, F.lit(False)))
    ends = F.explode(F.array(F.struct(F.col("a").alias("near"), "of_a.*"), F.struct(F.col("b").alias("near"), "of_b.*")))

    key = ["day", "nears", "far_key"]
    rows = own.select(*key, "near", "wei", "ts", "n").unionByName(both.select(*key, ends.alias("e")).select(*key, "e.*"))
    rows = rows.repartition(*key).dropDuplicates([*key, "near"])
    times = F.size(F.filter("nears", lambda x: x == F.col("near")))
    scored = rows.withColumn("_time", F.explode(F.sequence(F.lit(1), times))).groupBy(*key).agg(
        F.sum("wei").alias("sum_value_wei"), F.max("ts").alias("last_ts"), F.sum("n").alias("tx_cnt"))
    ranked = top_k(scored, ["day", "nears"], [F.desc_nulls_last("sum_value_wei"), F.desc_nulls_last("last_ts"), F.asc_nulls_first("far_key")], k)
    return ranked.select("day", "nears", F.col("far_key.far").alias("neighbor2_addr"), "sum_value_wei", "last_ts", "tx_cnt")


#: Seeds of one neighbour and day that meet its transfers in one place, and heavier neighbours that may be broadcast.
SEEDS_A_PART = 1_000
HUBS_BROADCAST_ROWS = 200_000


def g_two_hop_raw(tx_days: DataFrame, l1: DataFrame, seeds_a_part: int = SEEDS_A_PART) -> DataFrame:
    """Older variant: every transfer touching a first-hop neighbour that day, tagged with the seed.

    The result holds a hub's transfers once per seed that lists the hub.  The seeds of a hub are dealt
    into parts of about ``seeds_a_part``, each with a copy of the hub's transfers: the parts are joined in
    different tasks, and what is copied stays a small share of what comes out.
    """
    l1k = l1.where(F.col("neighbor_addr").isNotNull()).select("seed_addr", F.col("neighbor_addr").alias("ep"), "day")
    hubs = l1k.groupBy("day", "ep").agg(F.ceil(F.count(F.lit(1)) / seeds_a_part).cast("int").alias("parts")).where("parts > 1")
    hubs = sized_broadcast(hubs, HUBS_BROADCAST_ROWS)
    parts = F.coalesce("parts", F.lit(1))
    l1k = l1k.join(hubs, ["day", "ep"], "left").select("day", "ep", "seed_addr", F.pmod(F.xxhash64("seed_addr"), parts).cast("int").alias("part"))
    ends = tx_days.select(*TX_COLS, F.explode(F.array("from_address", "to_address")).alias("ep")).where(F.col("ep").isNotNull())
    ends = probable_members(ends, l1k.select("day", "ep").distinct(), ["day", "ep"])
    ends = ends.join(hubs, ["day", "ep"], "left").select(*TX_COLS, "ep", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return ends.join(l1k, ["day", "ep", "part"]).select(*TX_COLS, "seed_addr")


def g_frontier(l1: DataFrame, l2: DataFrame) -> DataFrame:
    return (l1.select("seed_addr", "day", F.col("neighbor_addr").alias("addr"))
            .unionByName(l2.select("seed_addr", "day", F.col("neighbor2_addr").alias("addr"))))


def dust_ok(min_wei) -> Column:
    if min_wei is None:
        return F.lit(True)
    return F.col("value_wei_raw") >= F.lit(int(min_wei)).cast("decimal(38,0)")


def g_e1_dust(e1: DataFrame, min_wei=DUST_WEI) -> DataFrame:
    return e1.where(dust_ok(min_wei)).select(*TX_COLS)


def _e2(sides: DataFrame, l1: DataFrame, l2: DataFrame, directions: list, cap: int, min_wei) -> DataFrame:
    """Transfers between a first-hop neighbour (near) and a second-hop one (far) of a seed and
    day.  A seed's neighbours of both hops are paired first (a few per seed and day), so a hub's
    transfers meet only the seeds that chose their far end; of a pair's transfers no seed takes
    more than the first ``cap``, so only those go on."""
    order = [F.desc_nulls_last("value_wei_raw"), F.desc_nulls_last("block_number"), F.asc_nulls_first("tx_hash")]
    t = top_k(sides.where(dust_ok(min_wei) & F.col("dir").isin(directions)), ["day", "dir", "near", "far"], order, cap)
    seeds = l1.select("seed_addr", "day", F.col("neighbor_addr").alias("near"))
    ends = seeds.join(l2.select("seed_addr", "day", F.col("neighbor2_addr").alias("far")), ["seed_addr", "day"])
    capped = top_k(t.join(ends, ["day", "near", "far"]), ["seed_addr", "day", "dir", "near", "far"], order, cap)
    return capped.select(*TX_COLS)


def g_e2_out(tx_days, l1, l2, cap: int = 20, min_wei=DUST_WEI) -> DataFrame:
    """Transfers first-hop → chosen second-hop, at most ``cap`` per (seed, day, from, to)."""
    return _e2(near_sides(tx_days, l1), l1, l2, ["out"], cap, min_wei)


def g_e2_in(tx_days, l1, l2, cap: int = 20, min_wei=DUST_WEI) -> DataFrame:
    """Transfers chosen second-hop → first-hop, at most ``cap`` per (seed, day, to, from)."""
    return _e2(near_sides(tx_days, l1), l1, l2, ["in"], cap, min_wei)


def g_final_tx(e1, tx_days, l1, l2, cap: int = 20, min_wei=DUST_WEI, sides: DataFrame | None = None) -> DataFrame:
    """First-hop edges and, in one pass, second-hop edges of both directions."""
    sides = near_sides(tx_days, l1) if sides is None else sides
    return g_e1_dust(e1, min_wei).unionByName(_e2(sides, l1, l2, ["out", "in"], cap, min_wei))


def g_edge_features(final_tx: DataFrame) -> DataFrame:
    """One row per (tx, day): exact wei value and fee, input size in bytes, creation flag."""
    a = final_tx.groupBy("tx_hash", "day").agg(
        F.any_value(F.lower("from_address")).alias("from_address"),
        F.any_value(F.lower("to_address")).alias("to_address"),
        F.any_value("block_number").alias("block_number"),
        F.any_value("timestamp").alias("timestamp"),
        F.any_value("value_wei_raw").alias("_v"),
        F.any_value("gas_price_wei").alias("_gp"),
        F.any_value("gas_used").alias("_gu"),
        F.any_value("nonce").alias("nonce"),
        F.any_value("input_length").alias("_in"),
    )
    return a.select(
        "from_address", "to_address", "block_number", "timestamp",
        F.col("_v").cast("decimal(38,0)").alias("value_wei"),
        F.try_multiply(F.col("_gp").cast("decimal(38,0)"), F.col("_gu").cast("decimal(38,0)"))
         .cast("decimal(38,0)").alias("tx_fee_wei"),
        "nonce",
        F.floor(strict_greatest(F.col("_in") - 2, F.lit(0)) / 2).cast("bigint").alias("input_data_size"),
        F.col("to_address").isNull().alias("contract_creation"),
        "tx_hash", "day",
    )


EDGE_KEY = ["day", "tx_hash"]


def append_keyed(rows: DataFrame, path: str, keys: list, partition_col: str = "day") -> DataFrame:
    """Insert the rows whose key the table does not hold yet; create the table if missing.

    Rows of earlier batches stay, and a replayed batch adds nothing.  Only the partitions
    the batch touches are read; a hot partition is split over several tasks and files.
    """
    spark = rows.sparkSession
    new = rows.dropDuplicates(keys)
    if path_exists(spark, path):
        days = [r[0] for r in new.select(partition_col).distinct().collect()]     # a calendar's worth
        touched = F.col(partition_col).isin([d for d in days if d is not None])
        touched = touched | F.col(partition_col).isNull() if None in days else touched
        stored = spark.read.schema(rows.schema).parquet(path).where(touched).select(*[F.col(k).alias(f"_{k}") for k in keys])
        new = new.join(stored, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    new.hint("rebalance", partition_col).write.mode("append").partitionBy(partition_col).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def g_append_final(edges: DataFrame, path: str) -> DataFrame:
    """Append a batch of daily edges to the edge table, keyed by (day, transaction)."""
    return append_keyed(edges, path, EDGE_KEY).select(*edges.columns)


def build_graph(tx: DataFrame, accounts: DataFrame, as_of, k1: int | None = 15, k2: int = 5, cap: int = 20,
                min_wei=DUST_WEI, scope: str = "batch", materialize: bool = True) -> dict:
    """The whole neighbourhood build; returns every stage by name, each made when it is first asked for.

    With ``materialize`` what later steps read again is checkpointed into the shared
    checkpoint folder: the first-hop edges, the ranked neighbours, and the transfer sides
    that touch a first-hop neighbour.  So the ledger is read twice, and a lost executor
    does not replay those scans.
    """
    from hopweave.session import cut_lineage
    seeds = g_seeds(accounts, as_of)
    win = seed_window(seeds)
    keep = cut_lineage if materialize else (lambda df: df)
    later = dict(
        e1=lambda s: keep(g_first_hop(tx, seeds, win)),
        l1=lambda s: keep(g_l1_topk(s["e1"], k1)),
        txd=lambda s: g_active_days_filter(tx, s["l1"], win),
        sides=lambda s: keep(near_sides(s["txd"], s["l1"])),
        l2=lambda s: keep(g_l2_topk(s["txd"], s["l1"], k2, scope=scope, sides=s["sides"])))
    return Stages(dict(tx=tx, seeds=seeds, cap=cap, min_wei=min_wei), later)


def build_edges(stages: dict) -> DataFrame:
    s = stages
    return g_edge_features(g_final_tx(s["e1"], s["txd"], s["l1"], s["l2"], s["cap"], s["min_wei"], s["sides"]))
