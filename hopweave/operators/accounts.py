"""Account table: labels + activity bounds + contract flag, and class balancing.

Scale notes
-----------
* The OR join "address is sender or receiver" is rewritten as an explode of
  the distinct endpoints followed by one equi-join, then min/max per account
  (partial aggregation map-side).  The account list is broadcast only when a
  count proves it small; otherwise it is a shuffle join (runtime bloom filter
  on the ledger side, AQE skew split for hot addresses).
* Balancing needs a handful of counts (one aggregate, collected as scalars)
  and "the first n accounts in seeded-hash order".  The hash is uniform, so the
  pick is exact without a global sort: count rows per 16-bit hash bucket (at
  most 65,536 numbers reach the driver), keep every bucket below the cutoff
  bucket, and order only the cutoff bucket (about total / 65,536 rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopweave.functions.common import round_half_up, sized_broadcast, stable_hash, utc_ts
from hopweave.session import cut_lineage

# ---- fixed values (patterns must equal the source pipeline's) -----------------
# Exchange / DEX / aggregator names used by the balancing step.
EXCHANGE_PATTERN = (
    r"(exchange|binance|coinbase|kraken|okx|okex|huobi|htx|bybit|bitfinex|kucoin|gate\.?io|mexc|gemini|"
    r"poloniex|bittrex|bitstamp|okcoin|upbit|lbank|bitmart|bitget|whitebit|bitso|wazirx|coincheck|liquid|"
    r"zaif|bithumb|korbit|coinone|bitflyer|bitbank|idex|dydx|uniswap|sushiswap|curve|balancer|1inch|"
    r"paraswap|matcha|cow\s*swap)"
)
# Shorter list used to split heavy accounts in the daily build.
EXCHANGE_PATTERN_SHORT = (
    r"(exchange|dex|binance|kraken|coinbase|okx|huobi|bybit|gate\.io|kucoin|mexc|uniswap|sushiswap|1inch|"
    r"paraswap|balancer|curve)"
)
KEEP_RATIO = 1.10
ENSURE_EXCH = 2000
SAMPLE_SEED = "42"

ACCOUNT_BROADCAST_ROWS = 200_000
ACCT_COLS = ["address", "is_scam", "description", "activity_start_ts", "activity_end_ts", "is_contract"]


def acct_distinct_labels(base0: DataFrame) -> DataFrame:
    return base0.select(F.lower("address").alias("address"), F.col("is_scam").cast("bigint").alias("is_scam"),
                        "description").distinct()


def _bounds(addrs: DataFrame, ledger: DataFrame) -> DataFrame:
    a = addrs.select("address").distinct()
    ends = ledger.select(utc_ts("block_timestamp").alias("ts"),
                         F.explode(F.array_distinct(F.array(F.lower("from_address"), F.lower("to_address")))).alias("ep"))
    ends = ends.where(F.col("ep").isNotNull())
    j = ends.join(sized_broadcast(a, ACCOUNT_BROADCAST_ROWS), ends.ep == a.address, "inner")
    return j.groupBy("address").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def acct_activity_bounds(addrs: DataFrame, transactions: DataFrame) -> DataFrame:
    """First and last transfer time of each account, as sender or receiver."""
    return _bounds(addrs, transactions)


def acct_token_bounds(addrs: DataFrame, token_transfers: DataFrame) -> DataFrame:
    """Same over token transfers."""
    return _bounds(addrs, token_transfers)


def acct_merge_bounds(addrs: DataFrame, tx_bounds: DataFrame, token_bounds: DataFrame,
                      as_unix: bool = True) -> DataFrame:
    """Earliest first / latest last over both sources (NULLs skipped); inactive accounts kept."""
    t = tx_bounds.select("address", F.col("first_ts").alias("t0"), F.col("last_ts").alias("t1"))
    k = token_bounds.select("address", F.col("first_ts").alias("k0"), F.col("last_ts").alias("k1"))
    j = addrs.join(t, "address", "left").join(k, "address", "left")
    first, last = F.least("t0", "k0"), F.greatest("t1", "k1")
    if as_unix:
        first, last = F.unix_seconds(first), F.unix_seconds(last)
    return j.select("address", "is_scam", "description", first.alias("activity_start_ts"),
                    last.alias("activity_end_ts"))


def acct_is_contract(accounts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Flag 1 when the address is a deployed contract (lookup de-duplicated first)."""
    lu = contracts.select(F.lower("address").alias("_c")).where(F.col("_c").isNotNull()).distinct()
    j = accounts.join(lu, accounts["address"] == lu["_c"], "left")
    return j.select(*accounts.columns, F.when(F.col("_c").isNotNull(), 1).otherwise(0).alias("is_contract"))


def is_exchange(description="description", pattern: str = EXCHANGE_PATTERN) -> Column:
    d = F.col(description) if isinstance(description, str) else description
    return F.lower(F.coalesce(d, F.lit(""))).rlike(pattern)


def acct_is_exchange(accounts: DataFrame) -> DataFrame:
    return accounts.select("*", is_exchange().alias("is_exchange"))


def acct_exchange_set(accounts: DataFrame) -> DataFrame:
    return (accounts.where(F.col("description").isNotNull()
                           & F.lower("description").rlike(EXCHANGE_PATTERN_SHORT))
            .select(F.lower("address").alias("address")).distinct())


def acct_non_exchange_set(accounts: DataFrame) -> DataFrame:
    ex = acct_exchange_set(accounts)
    a = accounts.select(F.lower("address").alias("address")).where(F.col("address").isNotNull()).distinct()
    return a.join(ex, "address", "left_anti")


def acct_balance_targets_df(base: DataFrame, keep_ratio: float = KEEP_RATIO) -> DataFrame:
    """One row of class counts; the derived targets are added in Python by ``acct_balance_targets``."""
    scam0 = F.col("is_scam") == 0
    con = F.col("is_contract") == 1
    eoa = F.coalesce(F.col("is_contract"), F.lit(0)) == 0
    ex = F.col("is_exchange")
    return acct_is_exchange(base).agg(
        F.count_if(F.col("is_scam") == 1).alias("pos"),
        F.count_if(scam0 & con & ex).alias("con_exch_avail"),
        F.count_if(scam0 & eoa & ex).alias("eoa_exch_avail"))


def acct_balance_targets(base: DataFrame, keep_ratio: float = KEEP_RATIO) -> dict:
    r = acct_balance_targets_df(base, keep_ratio).first()
    pos = int(r["pos"])
    neg = round_half_up(pos * keep_ratio)
    neg_c = neg // 2
    neg_e = neg - neg_c
    return dict(pos=pos, neg_total=neg, neg_contract=neg_c, neg_eoa=neg_e,
                con_exch_avail=int(r["con_exch_avail"]), eoa_exch_avail=int(r["eoa_exch_avail"]),
                con_exch_take=min(neg_c, int(r["con_exch_avail"])), eoa_exch_take=min(neg_e, int(r["eoa_exch_avail"])))


def targets_frame(spark, t: dict) -> DataFrame:
    return spark.createDataFrame([tuple(int(v) for v in t.values())], list(t.keys()))


def sample_key(seed: str = SAMPLE_SEED) -> Column:
    """Seeded, reproducible pseudo-random order key (ties broken by address)."""
    return stable_hash(F.concat(F.lit(seed), F.col("address")))


BUCKET_SHIFT = 44  # 60-bit key → 16-bit bucket


def first_n_by_key(df: DataFrame, n: int, key: Column, tie: str = "address") -> DataFrame:
    """The ``n`` rows with the smallest (key, tie), for a uniformly distributed
    non-negative 60-bit ``key`` — exact, and no task sees more than one bucket's rows."""
    if n <= 0:
        return df.limit(0)
    k = df.withColumn("_k", key).withColumn("_b", F.shiftright(F.col("_k"), BUCKET_SHIFT))
    counts = sorted((r["_b"], r["count"]) for r in k.groupBy("_b").count().collect())
    below, cut = 0, None
    for b, c in counts:
        if below + c >= n:
            cut = b
            break
        below += c
    if cut is None:  # fewer than n rows in total
        return df
    head = k.where(F.col("_b") < cut)
    edge = k.where(F.col("_b") == cut).orderBy("_k", tie).limit(n - below)
    return head.unionByName(edge).drop("_k", "_b")


def _first_n(df: DataFrame, n: int, seed: str) -> DataFrame:
    return first_n_by_key(df, n, sample_key(seed))


def first_n_per_group(df: DataFrame, group: Column, ns: dict, key: Column, tie: str = "address") -> DataFrame:
    """``first_n_by_key`` for several groups at once: one bucket-count job for all groups."""
    k = (df.withColumn("_g", group).withColumn("_k", key)
         .withColumn("_b", F.shiftright(F.col("_k"), BUCKET_SHIFT)))
    counts: dict = {}
    for r in k.groupBy("_g", "_b").count().collect():
        counts.setdefault(r["_g"], []).append((r["_b"], r["count"]))
    parts = []
    for g, n in ns.items():
        if n <= 0:
            continue
        below, cut = 0, None
        for b, c in sorted(counts.get(g, [])):
            if below + c >= n:
                cut = b
                break
            below += c
        kg = k.where(F.col("_g") == g)
        if cut is None:
            parts.append(kg)
            continue
        parts.append(kg.where(F.col("_b") < cut))
        parts.append(kg.where(F.col("_b") == cut).orderBy("_k", tie).limit(n - below))
    if not parts:
        return df.limit(0)
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out.drop("_g", "_k", "_b")


def acct_balance_pick(base: DataFrame, t: dict, seed: str = SAMPLE_SEED) -> DataFrame:
    """Negatives per type: exchanges first (up to the type's take), the rest from non-exchanges."""
    b = acct_is_exchange(base).where(F.col("is_scam") == 0)
    con = F.col("is_contract") == 1
    eoa = F.coalesce(F.col("is_contract"), F.lit(0)) == 0
    ex = F.col("is_exchange")
    group = (F.when(con & ex, 0).when(con & ~ex, 1).when(eoa & ex, 2).when(eoa & ~ex, 3))
    ns = {0: t["con_exch_take"], 1: t["neg_contract"] - t["con_exch_take"],
          2: t["eoa_exch_take"], 3: t["neg_eoa"] - t["eoa_exch_take"]}
    return first_n_per_group(b.where(group.isNotNull()), group, ns, sample_key(seed)).select(*ACCT_COLS)


def acct_balance_topup(base: DataFrame, initial: DataFrame, ensure_exch: int = ENSURE_EXCH,
                       seed: str = SAMPLE_SEED) -> DataFrame:
    """Top up exchanges to ``ensure_exch`` among the negatives, dropping as many
    non-exchanges of the same type (there are none to drop when a type's exchanges
    already exceeded its target, so the total can grow — as in the source)."""
    bx = acct_is_exchange(base)
    sel = bx.select("address", "is_exchange").join(initial.select("address"), "address", "inner")
    selected = sel.where(F.col("is_exchange")).count()
    if selected >= ensure_exch:
        return initial
    deficit = ensure_exch - selected
    cand = bx.where((F.col("is_scam") == 0) & F.col("is_exchange")).join(initial.select("address"), "address",
                                                                          "left_anti")
    extra = _first_n(cand, deficit, seed).select(*ACCT_COLS)
    cnt = extra.agg(F.count_if(F.col("is_contract") == 1).alias("c"),
                    F.count_if(F.coalesce(F.col("is_contract"), F.lit(0)) == 0).alias("e")).first()
    non_ex = bx.where(~F.col("is_exchange")).select("address")
    drop_cand = initial.join(non_ex, "address", "inner")
    drops = (_first_n(drop_cand.where(F.col("is_contract") == 1), int(cnt["c"]), seed).select(*ACCT_COLS)
             .unionByName(_first_n(drop_cand.where(F.coalesce(F.col("is_contract"), F.lit(0)) == 0), int(cnt["e"]),
                                   seed).select(*ACCT_COLS)))
    # (initial EXCEPT DISTINCT drops) UNION DISTINCT extra, read left to right.
    return initial.select(*ACCT_COLS).subtract(drops).union(extra).distinct()


def acct_balanced(base: DataFrame, keep_ratio: float = KEEP_RATIO, ensure_exch: int = ENSURE_EXCH,
                  seed: str = SAMPLE_SEED) -> DataFrame:
    """All scams plus the selected negatives."""
    t = acct_balance_targets(base, keep_ratio)
    initial = acct_balance_pick(base, t, seed)
    neg = acct_balance_topup(base, initial, ensure_exch, seed)
    return base.where(F.col("is_scam") == 1).select(*ACCT_COLS).unionByName(neg)


def acct_discarded(base: DataFrame, balanced: DataFrame) -> DataFrame:
    return base.select(*ACCT_COLS).join(balanced.select("address"), "address", "left_anti")


def build_account_table(base0: DataFrame, transactions: DataFrame, token_transfers: DataFrame,
                        contracts: DataFrame) -> DataFrame:
    addrs = acct_distinct_labels(base0)
    merged = acct_merge_bounds(addrs, acct_activity_bounds(addrs, transactions),
                               acct_token_bounds(addrs, token_transfers))
    # Kept once: balancing reads the table many times, the ledgers only here.
    return cut_lineage(acct_is_contract(merged, contracts))
