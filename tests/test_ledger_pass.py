"""The one ledger pass against the separate aggregates, its plan, and a hot account."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hopweave.operators import daily as D
from hopweave.operators import ledger_pass as L
from hopweave.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
T = dt.datetime


def ledgers(spark, hot=None, n=4000, seed=2):
    """Small ledgers with nulls, self-transfers and failures; ``hot`` is in half of all rows."""
    rnd = random.Random(seed)
    who = lambda: rnd.choice([None, *[f"0xA{k}" for k in range(300 if hot else 12)]])
    def ends(k):
        a, b = who(), who()
        return (hot if hot and k % 4 == 0 else a), (hot if hot and k % 4 == 1 else b)
    def when():
        return T(2024, 1, rnd.randint(1, 3), rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
    money = lambda: rnd.choice([None, *map(Decimal, (0, 5, 10**19 + 1))])
    tx = [(*ends(k), when(), money(), rnd.choice([0, 1]), rnd.choice([None, 21000]), money(), money(), money()) for k in range(n)]
    tok = [(*ends(k), rnd.choice([None, "0xT1", "0xt2"]), when()) for k in range(n // 2)]
    tr = [(*ends(k), money(), rnd.choice([0, 1]), "call", when()) for k in range(n // 2)]
    dec = "decimal(38,0)"
    return (spark.createDataFrame(tx, f"from_address string, to_address string, block_timestamp timestamp, value {dec}, receipt_status int, "
                                      f"receipt_gas_used long, receipt_effective_gas_price {dec}, max_fee_per_gas {dec}, max_priority_fee_per_gas {dec}"),
            spark.createDataFrame(tok, "from_address string, to_address string, token_address string, block_timestamp timestamp"),
            spark.createDataFrame(tr, f"from_address string, to_address string, value {dec}, status int, call_type string, block_timestamp timestamp"))


def normal(spark, **args):
    tx, tok, tr = ledgers(spark, **args)
    lo, hi = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    return D.d_tx_norm(tx, lo, hi), D.d_token_norm(tok, lo, hi), D.d_trace_norm(tr, lo, hi)


def rows(df, cols):
    return Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect())


def compare(spark, txn, tok, tr, accounts, **args):
    lu = spark.createDataFrame([("0xa1",), ("0xa2",), ("0xhot",)], "address string")
    days = L.ledger_days(txn, tok, tr, accounts, **args)
    moved, held, inner = L.transfer_days(days, lu), L.token_days(days), L.internal_days(days)
    mine = accounts.where("address is not null").distinct()
    of = lambda df, side: D.of_accounts(df, mine, side)
    want = [(D.d_sent(of(txn, "from_addr"), lu), moved.where("normal_sent_cnt > 0")), (D.d_recv(of(txn, "to_addr")), moved.where("normal_recv_cnt > 0")),
            (D.d_peers(txn, lu, mine), moved.where("uniq_peers_cnt > 0")), (D.d_token_sent(of(tok, "from_addr")), held.where("erc20_sent_cnt > 0")),
            (D.d_token_recv(of(tok, "to_addr")), held.where("erc20_recv_cnt > 0")), (D.d_internal(tr, mine), inner)]
    for old, new in want:
        assert rows(new, old.columns) == rows(old, old.columns), old.columns
    bins = D.minute_bins(D.activity_events(txn, tr, mine))
    got = days.where("kind = 'm'").selectExpr("address", "day", "m", "n_s as cnt", "t0", "t1")
    assert rows(got, bins.columns) == rows(bins, bins.columns)


def accounts(spark, *more):
    return spark.createDataFrame([(f"0xa{k}",) for k in range(9)] + [(m,) for m in (None, "0xa1", *more)], "address string")


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_pass_equals_the_separate_aggregates(spark, broadcast_rows):
    compare(spark, *normal(spark, n=1500), accounts(spark), broadcast_rows=broadcast_rows)


def test_empty_ledgers(spark):
    txn, tok, tr = (df.where("false") for df in normal(spark, n=10))
    assert L.ledger_days(txn, tok, tr, accounts(spark)).count() == 0


def test_hot_account_is_spread_and_adds_up(spark):
    txn, tok, tr = normal(spark, hot="0xHOT", n=12000)
    hot = accounts(spark, "0xhot")
    compare(spark, txn, tok, tr, hot)
    assert txn.where("from_addr = '0xhot' or to_addr = '0xhot'").count() * 2 >= txn.count() * 0.95
    # what the tasks behind the exchange read: the partial sums of every map task, dealt as the pass deals them
    tagged = L.tagged_rows(txn, tok, tr, lambda df: df.join(F.broadcast(hot.distinct()), "address", "left_semi"))
    dealt = tagged.repartition(8, *L.TAG).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    sizes = sorted(r["count"] for r in dealt)
    assert len(sizes) == 8 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    by_account = sorted(r["count"] for r in tagged.groupBy("address").count().collect())
    assert by_account[-1] > 3 * by_account[len(by_account) // 2]         # by account alone one task would read it all


def test_each_ledger_is_scanned_once_and_shuffled_once(spark):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stages = D.build_daily(fx.seed_accounts(spark, SF), fx.transactions(spark, SF), fx.token_transfers(spark, SF), fx.traces(spark, SF),
                               fx.contracts(spark, SF), "2024-01-31", materialize=False)
        days = stages["days"]._jdf.queryExecution().executedPlan().toString()
        assert days.count("events.parquet") == 3                         # the three stand-ins
        assert sum("hashpartitioning(address" in line and "kind" in line for line in days.splitlines()) == 1
        kept = D.build_daily(fx.seed_accounts(spark, SF), fx.transactions(spark, SF), fx.token_transfers(spark, SF), fx.traces(spark, SF),
                             fx.contracts(spark, SF), "2024-01-31")
        final = kept["final"]._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in final                             # only the kept table is read
        assert final.count("Exchange hashpartitioning") < 17
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_foreign_rows_are_left_out_of_the_kept_table(spark):
    days = spark.createDataFrame([("0xa1", 1), ("0xb", 2), ("0xa2", 3), ("0xb", 4)], "address string, n int")
    for listed, want in ((["0xa1", "0xa2"], [1, 3]), (["0xa1", "0xa2", "0xb"], [1, 2, 3, 4]), ([], [])):
        mine = spark.createDataFrame([(x,) for x in listed], "address string")
        for rows_ in (10, 0):
            assert sorted(r["n"] for r in L.of_listed(days, mine, rows_).collect()) == want


def test_kept_rows_are_written_unsorted_and_not_dealt_again(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "written", lambda df, name, *by: (seen.append((name, df._jdf.queryExecution().executedPlan().toString(),
                        spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))), df)[1])
    L.ledger_days(*normal(spark, n=200), accounts(spark), broadcast_rows=0)
    name, plan, writers = seen[0]
    assert name == "ledger-days" and int(writers) >= 4
    assert "LeftSemi" not in plan and "Sort " not in plan


def test_days_of_sorted_accounts_and_minutes_sorted_once(spark):
    at = T(2024, 1, 1)
    bounds = spark.createDataFrame([(f"0xa{k * 7 % 50:02d}", 0, "d", 0, at, at + dt.timedelta(3)) for k in range(50)],
                                   "address string, is_scam int, description string, is_contract int, activity_start_ts timestamp, activity_end_ts timestamp")
    for part in D.d_calendar_labels(bounds).select("address", "day").rdd.glom().collect():
        assert [tuple(r) for r in part] == sorted(tuple(r) for r in part)
    bins = spark.createDataFrame([("0xa1", at.date(), at, 1, at, at)], "address string, day date, m timestamp, cnt long, t0 timestamp, t1 timestamp")
    plan = D._day_stats(bins)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Sort [") == 1
