"""Sinks lose nothing: batches, reloads, resumed windows, parts with unequal schemas; bad flags."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hopweave import session
from hopweave.operators import daily as D
from hopweave.operators import graph as G
from hopweave.operators import labels as L
from hopweave.operators import publish as P
from hopweave.operators import shrink as S
from hopweave.operators import windows as W

EDGE = "day date, tx_hash string, v int"


def day(n):
    return dt.date(2024, 1, n)


def test_append_keeps_earlier_batches_and_replays_add_nothing(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "edges")
    one = spark.createDataFrame([(day(1), "a", 1), (day(1), "b", 1), (None, None, 1)], EDGE)
    two = spark.createDataFrame([(day(1), "b", 2), (day(1), "c", 2), (day(2), "a", 2), (day(2), "a", 2)], EDGE)
    for batch in (one, two, two, one):
        got = G.g_append_final(batch, path)
    assert sorted((r.day, r.tx_hash, r.v) for r in got.where("day is not null").collect()) == [
        (day(1), "a", 1), (day(1), "b", 1), (day(1), "c", 2), (day(2), "a", 2)]
    assert got.where("day is null").count() == 1


def test_reload_deletes_the_whole_shard_and_keeps_the_others(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "daily")
    rows = [(f"0x{k}", day(d), k * d) for k in range(40) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "address string, day date, v long")
    shard = D.hash_shard("address", 8)
    D.reload_shards(df, path, 8, 0, 7)
    D.reload_shards(df.where(F.col("day") > day(2)).withColumn("v", F.lit(-1).cast("long")), path, 8, 0, 3)
    got = {(r.address, r.day): r.v for r in spark.read.parquet(path).collect()}
    low = {r.address for r in df.where(shard <= 3).collect()}
    assert got == {(a, d): (-1 if a in low else v) for a, d, v in rows if a not in low or d == day(3)}
    # a group: its rows are replaced, other rows of the shards stay
    group = spark.createDataFrame([(a.upper(),) for a in sorted(low)[:3]], "address string")
    D.reload_shards(df.where(F.col("day") == day(1)), path, 8, 0, 3, group=group)
    got2 = {(r.address, r.day): r.v for r in spark.read.parquet(path).collect()}
    members = set(sorted(low)[:3])
    want = {k: v for k, v in got.items() if k[0] not in members} | {(a, d): v for a, d, v in rows if a in members and d == day(1)}
    assert got2 == want


def test_resume_keeps_windows_that_are_there(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "weekly")
    schema = "node_id long, week string"
    W.write_parts(spark.createDataFrame([(1, "2024-W01"), (2, "2024-W02")], schema), path, "week")
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    got = W.write_parts(spark.createDataFrame([(9, "2024-W01"), (3, "2024-W03")], schema), path, "week")
    assert sorted((r.node_id, r.week) for r in got.collect()) == [(1, "2024-W01"), (2, "2024-W02"), (3, "2024-W03")]
    after = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert before.items() <= after.items()


def test_slices_are_files_per_window(spark, tmpdir_fresh):
    from hopweave.plans.q_windows import edges
    e = edges(spark, "/root/testdata/sf0.001")
    got = W.write_slices(e, os.path.join(tmpdir_fresh, "slices"), "month", rows_per_file=200)
    assert got.count() == W.w_slices(e, "month").count()
    assert all(d == "_SUCCESS" or d.startswith(("month=", ".")) for d in os.listdir(os.path.join(tmpdir_fresh, "slices")))


def test_compact_raises_on_unequal_schemas_and_casts_when_unifying(spark, tmpdir_fresh):
    a, b, out = (os.path.join(tmpdir_fresh, x) for x in "abo")
    spark.createDataFrame([(1, 1)], "id long, a int").coalesce(1).write.parquet(a)
    spark.createDataFrame([(2, 2, "x")], "id int, a long, b string").coalesce(1).write.parquet(b)
    with pytest.raises(ValueError, match="different schemas"):
        P.pub_compact(spark, [a, b], out)
    got = P.pub_compact(spark, [a, b], out, unify_schema=True)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("id", "bigint"), ("a", "int"), ("b", "string")]
    assert sorted(map(tuple, got.collect())) == [(1, 1, None), (2, 2, "x")]


def test_flags_that_are_not_numbers_mean_zero(spark):
    a = ["0x" + f"{k}" * 40 for k in range(6)]
    flags = ["nan", "", "text", "1.9", "Infinity", "1"]
    rows = spark.createDataFrame([(x, f, None, k) for k, (x, f) in enumerate(zip(a, flags))], "address string, is_scam string, description string, row_no long")
    got = {r.address: r.is_scam for r in L.lbl_merge_priority([rows]).collect()}
    assert got == dict(zip(a, [0, 0, 0, 1, 0, 1]))
    wide = spark.createDataFrame(list(zip(a, flags)), "address string, Mint string")
    assert [r.is_scam for r in L.lbl_any_flag(wide).orderBy("address").collect()] == [0, 0, 0, 1, 0, 1]
    nodes = spark.createDataFrame(list(zip(a, flags)), "node string, isp string")
    assert [r.is_scam for r in L.lbl_node_attr(nodes).orderBy("address").collect()] == [0, 0, 0, 1, 0, 1]


def test_triplets_pair_left_to_right():
    assert L.triplet_layout(["Scam", "Tx_total", "Types", "Other", " tx count", "attack_type", "Alone", "txs"]) == [
        ("Scam", "Scam"), ("Other", "Other"), ("Alone", ""), ("txs", "")]


def test_idle_runs_by_hand(spark):
    marks = spark.createDataFrame([("a", dt.date(2024, 1, 1) + dt.timedelta(weeks=k), v) for k, v in enumerate([0, 0, 5, 0, 0, 0, 0, 0, 7, 0])],
                                  "address string, week date, week_activity long")
    run = lambda mode: [(r.run_no, r.place, r.run_weeks) for r in S.p_run_place(S.p_idle_runs(marks, mode), mode).orderBy("week").collect()]
    assert run("strict") == [(1, 1, 2), (1, 2, 2), (1, None, None), (2, 1, 5), (2, 2, 5), (2, 3, 5), (2, 4, 5), (2, 5, 5), (2, None, None), (3, 1, 1)]
    assert run("reference") == [(0, 1, 3), (0, 2, 3), (0, None, None), (1, 1, 6), (1, 2, 6), (1, 3, 6), (1, 4, 6), (1, 5, 6), (1, None, None), (2, 1, 1)]


def test_staged_paths_are_new_and_overwrite_mode_is_left_alone(spark):
    assert session.stage_path(spark, "x") != session.stage_path(spark, "x")
    from __spark_entry__ import queries
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    queries()["g_seeds"](spark, "/root/testdata/sf0.001").count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
