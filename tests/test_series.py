"""Interval-coded series against the dense operators on hand-made accounts, and their plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopweave.operators import series, shrink, windows

D = dt.date
DAYS = "address string, day date, normal_total_cnt long, erc20_total_cnt long, internal_in_cnt long, internal_out_cnt long, eth_recv_sum double"


def sparse(spark, seed=3):
    rnd = random.Random(seed)
    days, spans = [], []
    for a in range(14):
        first = D(2023, 1, 1) + dt.timedelta(days=rnd.randrange(30))
        n = rnd.choice([0, 3, 10, 70, 200])
        spans.append((f"a{a}", first, first + dt.timedelta(days=n)))
        for k in sorted(rnd.sample(range(n + 1), min(n + 1, rnd.choice([0, 1, 2, 5, 12])))):
            days.append((f"a{a}", first + dt.timedelta(days=k), rnd.choice([0, 1, 2, None]), rnd.choice([0, 1]), None, 0, rnd.choice([0.0, 1.25, None])))
    days += [days[0]] * 2                                    # a repeated day adds up
    days += [("a1", D(2030, 1, 1), 5, 5, 5, 5, 1.0), ("nobody", D(2023, 1, 5), 1, 1, 1, 1, 1.0)]
    return spark.createDataFrame(days, DAYS), spark.createDataFrame(spans, "address string, first_day date, last_day date")


def dense(days, spans):
    measures = days.columns[2:]
    sums = days.groupBy("address", "day").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures])
    cal = spans.select("address", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return cal.join(sums, ["address", "day"], "left").fillna(0).select(*days.columns)


def rows(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("mode", ["reference", "strict"])
@pytest.mark.parametrize("every", [1, 2, 4])
def test_runs_and_kept_weeks_equal_the_dense_form(spark, mode, every):
    days, spans = sparse(spark)
    base = shrink.p_day_activity(dense(days, spans))
    if every == 4:
        cols = ["address", "week", "week_activity", "is_idle", "run_no", "place", "run_weeks"]
        want = rows(shrink.p_run_place(shrink.p_idle_runs(shrink.p_week_marks(base), mode), mode), *cols)
        assert rows(series.idle_runs(days, spans, mode), *cols) == want
        assert rows(series.week_marks(days, spans), *cols[:3]) == rows(shrink.p_week_marks(base), *cols[:3])
    want = rows(shrink.p_keep_weeks(base, every, mode), *base.columns)
    assert rows(series.keep_weeks(days, spans, every, mode), *base.columns) == want


def test_days_of_kept_weeks_are_neither_joined_nor_sorted(spark):
    days, spans = sparse(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = series.keep_weeks(days, spans)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    above = plan[:plan.index("Generate explode(sequence(")]
    assert not any(step in above for step in ("Join", "Sort", "Exchange", "Aggregate"))
    shuffles = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffles and all("hashpartitioning(address" in line for line in shuffles)


def test_rollups_equal_the_dense_form(spark):
    days, spans = sparse(spark, 5)
    amap = spark.createDataFrame([(f"A{a}", a % 5) for a in range(12)], "address string, node_id long")   # nodes with several accounts
    daily = windows.s_daily_filtered(dense(days, spans), amap)
    index = daily.select("week").distinct().where("substr(week, 7) % 3 <> 0")
    sparse_days, node_spans = series.mapped(days, spans, amap)
    got, want = series.weekly(sparse_days, node_spans, index), windows.s_weekly(daily, index)
    assert rows(got, *want.columns) == rows(want, *want.columns)
    months = series.week_month_map(node_spans)
    assert rows(months, "week", "month") == rows(windows.s_week_month_map(daily), "week", "month")
    m = daily.select("month").distinct()
    by_month = windows.s_monthly(want, windows.s_week_month_map(daily), m)
    assert rows(series.monthly(sparse_days, node_spans, index, m), *by_month.columns) == rows(by_month, *by_month.columns)
    assert rows(windows.s_monthly(got, months, m), *by_month.columns) == rows(by_month, *by_month.columns)


def test_empty_series(spark):
    days, spans = sparse(spark)
    none = spans.where("false")
    assert series.idle_runs(days, none).count() == 0 and series.keep_weeks(days, none).count() == 0
    runs = series.idle_runs(days.where("false"), spans, "strict").groupBy("address").agg(F.max("run_no").alias("n"), F.min(F.col("is_idle").cast("int")).alias("i"))
    assert {(r["n"], r["i"]) for r in runs.collect()} == {(1, 1)}


def test_rollups_generate_no_days_and_runs_shuffle_by_address_only(spark):
    days, spans = sparse(spark)
    amap = spark.createDataFrame([("a1", 1)], "address string, node_id long")
    d, s = series.mapped(days, spans, amap)
    index = spark.createDataFrame([("2023-W02",)], "week string")
    month = spark.createDataFrame([("2023-01",)], "month string")
    for df in (series.weekly(d, s, index), series.monthly(d, s, index, month)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(first_day" not in plan and "Generate" in plan
        assert "sequence(cast(first_day" not in plan
    plan = series.idle_runs(days, spans)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffles and all("hashpartitioning(address" in line for line in shuffles)


def test_week_labels_and_numbers_agree(spark):
    days = spark.range(0, 366 * 12).select(F.date_add(F.lit("2014-12-25"), F.col("id").cast("int")).alias("day"))
    from hopweave.functions.common import iso_week
    bad = days.where((series.label_week_no(iso_week("day")) != series.week_no(F.col("day"))) | (F.weekday(series.monday(series.week_no(F.col("day")))) != 0)
                     | ~F.datediff("day", series.monday(series.week_no(F.col("day")))).between(0, 6))
    assert bad.count() == 0
