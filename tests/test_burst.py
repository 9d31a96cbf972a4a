"""The dense burst: equal to the plain rule, and nothing that grows with the accounts' days is broadcast."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hopweave.operators import daily as D

DAY = dt.datetime(2024, 1, 2)


def _events(spark, rows):
    return spark.createDataFrame([(a, None if t is None else t.date(), t) for a, t in rows], "address string, day date, ts timestamp")


def _calendar(spark, rows):
    return spark.createDataFrame(rows, "address string, day date")


@pytest.mark.parametrize("minutes", [1, 2, 5])
def test_dense_burst_equals_the_plain_rule(spark, minutes):
    """Several accounts and days, full minutes, days outside the calendar, missing times; the whole first and last minute of a day."""
    r = random.Random(minutes)
    rows = [(f"0x{r.randint(0, 3)}", DAY + dt.timedelta(days=r.randint(0, 2), minutes=r.choice([0, 1, 2, 3, 9, 700, 704, 1439]), seconds=r.randint(0, 59)))
            for _ in range(160)] + [("0x0", None), ("0x9", None)]
    days = [(f"0x{a}", (DAY + dt.timedelta(days=n)).date()) for a in range(3) for n in range(2)]
    got = D.d_burst_dense(_events(spark, rows), _calendar(spark, days + days[:1]), minutes).collect()
    want = {}
    for a, t in rows:
        if t and (a, t.date()) in days:
            at = t.replace(second=0)
            near = sum(1 for b, u in rows if u and b == a and u.date() == t.date() and at - dt.timedelta(minutes=minutes - 1) <= u.replace(second=0) <= at)
            want[a, t.date()] = max(near, want.get((a, t.date()), 0))
    assert {(x.address, x.day): x.burst_max_tx_5m for x in got} == want and len(got) == len(want)


def test_the_calendar_is_not_broadcast_and_the_grid_not_sorted(spark):
    events = _events(spark, [("0xa", DAY), ("0xa", DAY + dt.timedelta(minutes=1439))])
    df = D.d_burst_dense(events, _calendar(spark, [("0xa", DAY.date())]))
    assert df.first().burst_max_tx_5m == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Window" not in plan and "explode" not in plan


def test_events_of_a_long_account_list(spark):
    """Beyond the broadcast bound no event of an account is lost, and events are not shuffled for the list."""
    txn = spark.createDataFrame([(f"0x{i}", None if i % 3 else f"0x{i + 1}", DAY.date(), DAY) for i in range(60)],
                                "from_addr string, to_addr string, day date, block_timestamp timestamp")
    tr = txn.select("*", F.lit(1).alias("status"), F.lit(1.0).alias("eth_value"), F.lit(1).alias("value_wei"))
    bounds = spark.createDataFrame([(f"0x{i}",) for i in range(0, 60, 2)] + [("0x0",), (None,)], "address string")
    exact = D.account_events(txn, tr, bounds)
    paged = D.account_events(txn, tr, bounds, broadcast_rows=0)
    assert exact.count() == paged.where("cast(substr(address, 3) as int) % 2 = 0 and address != '0x60'").count() == 80
    assert "SortMergeJoin" not in paged._jdf.queryExecution().executedPlan().toString()
