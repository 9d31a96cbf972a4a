"""Bit pages lose no member, let few others pass, and keep the ledger's shuffle small."""

import datetime as dt

from pyspark.sql import functions as F

from hopweave.functions import membership
from hopweave.operators import graph as G
from hopweave.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def test_no_member_is_lost_and_few_others_pass(spark):
    rows = spark.range(200_000).selectExpr("concat('k', id) as k", "id % 7 as d", "id")
    members = rows.where("id % 20 = 3").select("d", "k")
    got = membership.probable_members(rows, members, ["d", "k"])
    assert got.columns == rows.columns
    assert got.where("id % 20 = 3").count() == 10_000
    assert got.where("id % 20 <> 3").count() < 0.01 * 190_000
    assert membership.probable_members(rows, members.where("false"), ["d", "k"]).count() == 0


def test_too_many_members_leave_the_table_as_it_is(spark):
    rows = spark.range(100).selectExpr("id as k")
    assert membership.probable_members(rows, rows, ["k"], most_pages=0) is rows


def test_sides_that_reach_the_exact_join_are_below_twice_those_kept(spark):
    day = dt.date(2024, 1, 1)
    tx = G.normalize_tx(fx.transactions(spark, SF))
    busy = tx.select("day", F.col("from_address").alias("neighbor_addr")).distinct().where("abs(xxhash64(neighbor_addr)) % 50 = 0") \
        .withColumn("seed_addr", F.lit("0xs"))
    kept = G.near_sides(tx, busy, G.RANK_COLS)
    probable = G.probable_sides(tx, G.wanted_sides(busy), G.RANK_COLS)
    sides, passed, exact = 2 * tx.count(), probable.count(), kept.count()
    assert 0 < exact <= passed < 2 * exact < sides / 4, (day, exact, passed, sides)
    wanted = G.wanted_sides(busy)
    ends = tx.select(F.col("from_address").alias("near"), "day").unionByName(tx.select(F.col("to_address").alias("near"), "day"))
    assert exact == ends.join(wanted, ["day", "near"]).count()
    # the ledger itself meets the pages without a shuffle
    plan = probable._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan
