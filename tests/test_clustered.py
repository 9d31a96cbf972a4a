"""Clustered stage tables: a join and a window on the key without any exchange."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from hopweave.operators import clustered as C


def test_join_and_window_on_the_key_need_no_exchange(spark):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    a, b = (f"t_{uuid.uuid4().hex[:8]}" for _ in "ab")
    try:
        moves = spark.range(5000).selectExpr("concat('0x', id % 97) as address", "id as ts", "id * 3 as v").union(
            spark.createDataFrame([(None, 1, 2)], "address string, ts long, v long"))
        who = spark.range(97).selectExpr("concat('0x', id) as address", "id % 2 as flag")
        left = C.write_clustered(moves, a, ["address"], 8, sort=["address", "ts"])
        right = C.write_clustered(who, b, ["address"], 8)
        gap = F.col("ts") - F.lag("ts").over(Window.partitionBy("address").orderBy("ts"))
        joined = left.withColumn("gap", gap).join(right, "address").groupBy("address", "flag").agg(F.sum("v").alias("v"), F.max("gap").alias("gap"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Window" in plan
        want = moves.withColumn("gap", gap).join(who, "address").groupBy("address", "flag").agg(F.sum("v").alias("v"), F.max("gap").alias("gap"))
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))
        assert left.count() == 5001
        again = C.write_clustered(who.limit(3), b, ["address"], 8)          # replaced, not added to
        assert again.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
        C.drop_clustered(spark, a)
        C.drop_clustered(spark, b)


def test_bucket_counts_follow_the_rows():
    assert C.buckets_for(0) == 8 and C.buckets_for(41_000_000) == 16 and C.buckets_for(10**12) >= 10**12 / C.ROWS_A_BUCKET
