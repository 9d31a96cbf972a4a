"""Dense rows of the rollups are generated last, dealt parts are written where they are, and joins keep their size."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopweave.operators import parts, series, windows
from hopweave.sources import fixtures

D = dt.date
DAYS = "node_id long, day date, normal_total_cnt long, burst_max_tx_5m long, eth_recv_sum double"


def node_series(spark):
    rnd = random.Random(4)
    days, spans = [], []
    for node in (1, 2, 3, 4, None):
        for _ in range(1 if node != 2 else 3):                       # a node with several spans, far apart
            first = D(2022, 1, 1) + dt.timedelta(days=rnd.randrange(700))
            spans.append((node, first, first + dt.timedelta(days=rnd.choice([0, 5, 40, 400]))))
            days += [(node, first + dt.timedelta(days=rnd.randrange(60)), rnd.choice([1, None]), rnd.choice([-2, 7]), rnd.choice([0.5, None])) for _ in range(6)]
    days += [days[0], (9, D(2022, 3, 3), 4, -5, 1.0), (1, None, 1, 1, 1.0)]     # repeated; without a span; without a day
    spans += [(5, None, D(2022, 5, 5)), (6, D(2022, 2, 27), D(2022, 3, 2))]
    return spark.createDataFrame(days, DAYS), spark.createDataFrame(spans, "node_id long, first_day date, last_day date")


def plain_weekly(days, spans, index):
    """Every week of every span as a row of zeros, summed with the active days."""
    rows = days.select("node_id", series.week_no(F.col("day")).alias("week_no"), *days.columns[2:])
    weeks = spans.select("node_id", F.explode(F.sequence(series.week_no(F.col("first_day")), series.week_no(F.col("last_day")))).alias("week_no"))
    rows = rows.unionByName(weeks.select("*", F.lit(0).alias("normal_total_cnt"), F.lit(0).alias("burst_max_tx_5m"), F.lit(0.0).alias("eth_recv_sum")))
    rows = rows.join(index.select("week", series.label_week_no(F.col("week")).alias("week_no")), "week_no")
    return rows.groupBy("node_id", "week").agg(*windows.series_aggs(rows.drop("week_no")))


def counted(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("share", [None, 2])
def test_weeks_of_blocks_equal_a_plain_sum(spark, share):
    days, spans = node_series(spark)
    index = spark.range(0, 900, 7).select(series.iso_week(F.date_add(F.lit("2022-01-03"), F.col("id").cast("int"))).alias("week")).where("substr(week, 7) % 5 <> 0")
    want = plain_weekly(days, spans, index)
    assert counted(series.weekly(days, spans, index, share), *want.columns) == counted(want, *want.columns)


def test_months_equal_a_plain_join(spark):
    days, spans = node_series(spark)
    index = spark.range(0, 900, 7).select(series.iso_week(F.date_add(F.lit("2022-01-03"), F.col("id").cast("int"))).alias("week")).where("substr(week, 7) % 5 <> 0")
    months = spark.createDataFrame([(f"{y}-{m:02d}",) for y in (2022, 2023) for m in range(1, 13) if m != 6], "month string")
    daily = spans.where("first_day is not null").select(F.explode(F.sequence("first_day", "last_day")).alias("d"))
    of_week = daily.select(series.iso_week("d").alias("week"), series.month_label("d").alias("month")).distinct()
    assert counted(series.week_month_map(spans), "week", "month") == counted(of_week, "week", "month")
    rows = plain_weekly(days.drop("burst_max_tx_5m").withColumn("burst_max_tx_5m", F.lit(0)), spans, index).drop("burst_max_tx_5m")
    want = windows.s_monthly(rows, of_week, months)
    got = series.monthly(days.drop("burst_max_tx_5m"), spans, index, months)
    assert counted(got, *want.columns) == counted(want, *want.columns)


def test_idle_weeks_and_months_are_neither_shuffled_nor_aggregated(spark):
    days, spans = node_series(spark)
    index = spark.createDataFrame([("2022-W10",)], "week string")
    month = spark.createDataFrame([("2022-03",)], "month string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for text, last in ((plan(series.weekly(days, spans, index)), "Generate explode(_wanted"), (plan(series.monthly(days, spans, index, month)), "Join")):
        above = text[:text.index(last)]
        assert not any(step in above for step in ("Aggregate", "Repartition", "Union"))


def test_dealt_parts_are_written_unsorted_and_whole(spark, tmpdir_fresh):
    rows = spark.range(200).select("id", (F.col("id") % 4).cast("string").alias("week")).repartition(2, "week")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    got = windows.write_parts(rows.where("week < '2'"), f"{tmpdir_fresh}/t", "week", dealt=True)
    got = windows.write_parts(rows, f"{tmpdir_fresh}/t", "week", dealt=True)
    assert counted(got, "id", "week") == counted(rows, "id", "week") and spark.conf.get(key) == before
    assert set(parts.part_rows(spark, f"{tmpdir_fresh}/t", "week").values()) == {50}


def test_lines_meet_their_orders_in_tasks_of_counted_size(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_A_PARTITION", 10)
    ts = dt.datetime(2022, 1, 1)
    spark.createDataFrame([(k, k % 50) for k in range(300)], "o_orderkey long, o_custkey long").write.parquet(f"{tmpdir_fresh}/orders.parquet")
    spark.createDataFrame([(k % 320, 1, 1, 1, 1.0, 1.0, 0.5, ts) for k in range(400)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp").write.parquet(f"{tmpdir_fresh}/lineitem.parquet")
    edges = fixtures.window_edges(spark, tmpdir_fresh)
    assert edges.count() == 380
    assert "RepartitionByExpression [l_orderkey#" in edges._jdf.queryExecution().optimizedPlan().toString()
