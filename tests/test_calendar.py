"""The dense calendar: equal to spans joined with days, and its days are neither shuffled nor sorted."""

import datetime as dt
import os

from pyspark.sql import functions as F

from hopweave.functions.common import iso_week, month_label
from hopweave.operators import shrink, windows
from hopweave.sources import fixtures as fx

D = dt.datetime(1995, 1, 1)


def _orders(spark, path, rows):
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string") \
        .write.parquet(os.path.join(path, "orders.parquet"))


def _some(spark, path):
    day = lambda n: D + dt.timedelta(days=n)
    _orders(spark, path, [(1, 1, "O", 10.0, day(0), "a"), (2, 1, "F", 20.5, day(0), "a"), (3, 1, None, None, day(40), "a"), (4, 1, "O", 7.0, day(9), "a"),
                          (5, 2, "O", 1.0, day(3), "a"), (5, 2, "O", 1.0, day(3), "a"), (6, 3, "O", 2.0, None, "a"), (7, 4, "O", 2.0, None, "a"),
                          (8, 4, "O", 2.0, day(5), "a"), (9, None, "O", 9.0, day(1), "a"), (10, None, "O", 9.0, day(4), "a")])


def _plain(spark, path):
    spans, days = fx.order_spans(spark, path), fx.order_days(spark, path)
    cal = spans.select("address", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return cal.join(days, ["address", "day"], "left").fillna(0).select(*days.columns)


def _sorted(df):
    return sorted(map(str, df.collect()))


def test_calendar_equals_spans_joined_with_days(spark, tmpdir_fresh):
    """Repeated orders, null status and price, null dates, an account that is null."""
    _some(spark, tmpdir_fresh)
    want = _sorted(_plain(spark, tmpdir_fresh))
    assert len(want) == 41 + 1 + 1 + 4
    assert _sorted(fx.order_calendar(spark, tmpdir_fresh)) == want
    assert _sorted(fx.order_calendar(spark, tmpdir_fresh, by=F.lower("address"))) == want


def _after_days(df):
    """The executed plan above the expansion into days."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[:text.rindex("Generate explode")]


def test_days_of_the_calendar_are_neither_joined_nor_sorted(spark, tmpdir_fresh):
    _some(spark, tmpdir_fresh)
    text = _after_days(shrink.p_day_activity(fx.order_calendar(spark, tmpdir_fresh)))
    assert "Exchange" not in text and "Join" not in text and "Sort" not in text


def test_mapped_and_kept_days_are_not_sorted(spark, tmpdir_fresh):
    _some(spark, tmpdir_fresh)
    ids = spark.createDataFrame([("0xA" + "1".zfill(39), 7)], "address string, node_id long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mapped = windows.s_daily_filtered(fx.order_calendar(spark, tmpdir_fresh, by=F.lower("address")), ids)
        text = mapped._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "ShuffledHashJoin" in text
        above = text[text.index("ShuffledHashJoin"):text.index("Generate explode")]
        assert "Exchange" not in above
        kept = shrink.p_keep_weeks(shrink.p_day_activity(fx.order_calendar(spark, tmpdir_fresh)))
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert mapped.count() == 41


def test_mapped_runs_equal_mapped_days(spark, tmpdir_fresh):
    """Runs meet the map before their days are generated; labels are looked up, those of days outside the list computed."""
    _some(spark, tmpdir_fresh)
    far = [dt.datetime(1969, 12, 28), dt.datetime(1970, 1, 2), dt.datetime(2069, 12, 30), dt.datetime(2070, 1, 4)]
    _orders(spark, tmpdir_fresh + "/far", [(20 + i, 5 + i // 2, "O", 3.0, d, "a") for i, d in enumerate(far)])
    ids = spark.createDataFrame([("0xA" + str(i).zfill(39), 7 + i) for i in (1, 4, 5, 6)] + [(None, 1), ("0xa" + "1".zfill(39), 3)], "address string, node_id long")
    low = F.lower("address")
    for path, n in ((tmpdir_fresh, 42), (tmpdir_fresh + "/far", 12)):
        dense = windows.s_daily_filtered(fx.order_calendar(spark, path, by=low), ids)
        mapped = windows.s_daily_filtered(fx.order_runs(spark, path, by=low), ids, until="until")
        plain = fx.order_calendar(spark, path).join(ids.groupBy(low.alias("address")).agg(F.min("node_id").alias("node_id")), "address") \
            .withColumns({"week": iso_week("day"), "month": month_label("day")}).select(*dense.columns)
        assert _sorted(mapped) == _sorted(dense) == _sorted(plain) and mapped.count() == n
        text = windows.s_daily_filtered(fx.order_runs(spark, path, by=low), ids, until="until", day_text=True)
        assert _sorted(text) == _sorted(plain.withColumn("day", F.col("day").cast("string")))
    plan = mapped._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan[:plan.index("ShuffledHashJoin")]
