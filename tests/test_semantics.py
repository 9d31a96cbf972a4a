"""Hand-made cases for the semantic notes and traps of the blueprint."""

import datetime as dt
import json
import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from hopweave.functions import common as C
from hopweave.operators import accounts as A
from hopweave.operators import daily as D
from hopweave.operators import graph as G
from hopweave.operators import labels as L
from hopweave.operators import publish as P
from hopweave.operators import shrink as S
from hopweave.operators import windows as W

T = dt.datetime


def test_strict_greatest_propagates_null(spark):
    r = spark.createDataFrame([(None, 3), (5, 3)], "a int, b int").select(
        C.strict_greatest("a", "b").alias("g")).collect()
    assert [x.g for x in r] == [None, 5]


def test_whole_minutes_truncate(spark):
    r = spark.createDataFrame([(T(2024, 1, 1, 0, 0, 59), T(2024, 1, 1, 0, 1, 1))], "a timestamp, b timestamp")
    assert r.select(C.whole_minutes("a", "b").alias("m")).first().m == 0


def test_iso_week_label(spark):
    r = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2024, 12, 30),)], "d date")
    assert [x.w for x in r.select(C.iso_week("d").alias("w")).collect()] == ["2020-W53", "2025-W01"]


def test_round_half_up_not_bankers():
    assert C.round_half_up(2.5) == 3 and C.round_half_up(134.2) == 134


def test_stable_hash_matches_duckdb(spark):
    import duckdb
    v = spark.createDataFrame([("abc",)], "x string").select(C.stable_hash("x").alias("h")).first().h
    assert v == duckdb.sql("select CAST('0x' || substr(md5('abc'), 1, 15) AS BIGINT)").fetchall()[0][0]


def _tx(rows):
    return [Row(hash=h, from_address=f, to_address=t, block_number=i, block_timestamp=ts, value=v, gas_price=10,
                receipt_gas_used=2, nonce=i, input=inp) for i, (h, f, t, ts, v, inp) in enumerate(rows)]


TX_SCHEMA = ("hash string, from_address string, to_address string, block_number long, block_timestamp timestamp, "
             "value long, gas_price long, receipt_gas_used long, nonce long, input string")


def test_self_transfer_enters_first_hop_twice_and_creation_gives_null_neighbour(spark):
    tx = spark.createDataFrame(_tx([
        ("h1", "0xS", "0xS", T(2024, 1, 2, 1), 5, "0x"),
        ("h2", "0xS", None, T(2024, 1, 2, 2), 7, "0xabcd"),
        ("h3", "0xB", "0xS", T(2024, 1, 9, 1), 9, None),   # outside the window
    ]), TX_SCHEMA)
    seeds = spark.createDataFrame([("0xs", T(2024, 1, 1), T(2024, 1, 5))], "address string, start_ts timestamp, end_ts timestamp")
    e1 = G.g_first_hop(tx, seeds)
    assert sorted(r.tx_hash for r in e1.collect()) == ["h1", "h1", "h2"]
    l1 = {r.neighbor_addr: int(r.sum_value_wei) for r in G.g_l1_topk(e1, 5).collect()}
    assert l1 == {"0xs": 10, None: 7}
    feat = {r.tx_hash: r for r in G.g_edge_features(G.g_e1_dust(e1, None)).collect()}
    assert feat["h2"].contract_creation and feat["h2"].input_data_size == 2
    assert feat["h1"].input_data_size == 0 and int(feat["h1"].tx_fee_wei) == 20


def test_l2_batch_scope_can_repeat_a_neighbour_global_cannot(spark):
    # seed S has first-hop neighbours in different hash batches; both touch X.
    names = [f"0xn{i}" for i in range(40)]
    batches = {r.n: r.b for r in spark.createDataFrame([(n,) for n in names], "n string")
               .select("n", G.l1_batch("n").alias("b")).collect()}
    a = names[0]
    b = next(n for n in names if batches[n] != batches[a])
    day = dt.date(2024, 1, 2)
    l1 = spark.createDataFrame([("0xs", a, day), ("0xs", b, day)], "seed_addr string, neighbor_addr string, day date")
    txd = spark.createDataFrame([(a, "0xx", T(2024, 1, 2, 1), 3, "t1", day), (b, "0xx", T(2024, 1, 2, 2), 4, "t2", day)],
                                "from_address string, to_address string, timestamp timestamp, value_wei_raw long, "
                                "tx_hash string, day date")
    batch = G.g_l2_topk(txd, l1, 5, scope="batch").where(F.col("neighbor2_addr") == "0xx").collect()
    glob = G.g_l2_topk(txd, l1, 5, scope="global").where(F.col("neighbor2_addr") == "0xx").collect()
    assert sorted(int(r.sum_value_wei) for r in batch) == [3, 4]
    assert [int(r.sum_value_wei) for r in glob] == [7] and glob[0].tx_cnt == 2


def _events(spark, rows):
    return spark.createDataFrame([("0xa", ts.date(), ts) for ts in rows], "address string, day date, ts timestamp")


def test_minute_bin_stats_equal_sorted_list_definition(spark):
    base = T(2024, 1, 2, 10, 0, 0)
    offs = [0, 5, 59, 61, 200, 1900, 1930, 1931, 1932, 1933, 1934, 5000, 5000, 7000]
    ts = [base + dt.timedelta(seconds=s) for s in offs]
    ev = _events(spark, ts)
    cal = spark.createDataFrame([("0xa", dt.date(2024, 1, 2)), ("0xa", dt.date(2024, 1, 3))], "address string, day date")
    st = {r.day: r for r in D.d_activity_stats(cal, ev).collect()}
    gaps = [int((b - a).total_seconds() // 60) for a, b in zip(ts, ts[1:])]
    mean = sum(gaps) / len(gaps)
    std = (sum((g - mean) ** 2 for g in gaps) / (len(gaps) - 1)) ** 0.5
    r = st[dt.date(2024, 1, 2)]
    assert abs(r.tx_interarrival_mean_min - mean) < 1e-9 and abs(r.tx_interarrival_std_min - std) < 1e-9
    assert r.sessions_cnt == 1 + sum(g > 30 for g in gaps)
    assert r.active_span_min == int((ts[-1] - ts[0]).total_seconds() // 60)
    dense = D.d_burst_dense(ev).first().burst_max_tx_5m
    assert r.burst_max_tx_5m == dense == 6
    idle = st[dt.date(2024, 1, 3)]
    assert (idle.tx_interarrival_mean_min, idle.active_span_min, idle.burst_max_tx_5m, idle.sessions_cnt) == (None, 0, 0, 0)


def test_hour_profile_peak_ties_take_smallest_hour(spark):
    ts = [T(2024, 1, 2, 3), T(2024, 1, 2, 3, 5), T(2024, 1, 2, 7), T(2024, 1, 2, 7, 1)]
    cal = spark.createDataFrame([("0xa", dt.date(2024, 1, 2))], "address string, day date")
    r = D.d_hour_profile(cal, _events(spark, ts)).first()
    assert r.peak_hour == 3 and r.peak_hour_share == 0.5 and r.tx_cnt_00_06 == 2 and r.active_hour_span == 4
    assert abs(r.activity_entropy_hours - (2 * -(0.5 * __import__("math").log(0.5))) / __import__("math").log(24)) < 1e-12


def test_bounds_drop_reversed_windows_and_fill_open_end(spark):
    acc = spark.createDataFrame([("0xA", 0, None, 0, T(2024, 1, 5), T(2024, 1, 1)),
                                 ("0xB", 1, "x", 1, T(2024, 1, 30), None)],
                                "address string, is_scam int, description string, is_contract int, "
                                "activity_start_ts timestamp, activity_end_ts timestamp")
    b = D.d_bounds(D.d_base(acc), "2024-01-31").collect()
    assert [(r.address, r.activity_end_ts) for r in b] == [("0xb", T(2024, 1, 31, 23, 59, 59))]
    cal = D.d_calendar_labels(D.d_bounds(D.d_base(acc), "2024-01-31")).orderBy("day").collect()
    assert [(r.dow, r.is_month_end, r.age_days) for r in cal] == [(1, 0, 0), (2, 1, 1)]


def test_week_thinning_golden_case(spark):
    acts = [0, 0, 5, 0, 0, 0, 0, 0, 2, 0, 0]
    monday = dt.date(2024, 1, 1)
    rows = [("0xa", monday + dt.timedelta(weeks=i), a, 0, 0, 0) for i, a in enumerate(acts)]
    light = spark.createDataFrame(rows, "address string, day date, normal_total_cnt long, erc20_total_cnt long, "
                                        "internal_in_cnt long, internal_out_cnt long")
    kept = S.p_keep_weeks(S.p_day_activity(light)).collect()
    weeks = sorted((r.day - monday).days // 7 + 1 for r in kept)
    assert weeks == [1, 3, 4, 8, 9, 10, 11]


def test_balancing_top_up_grows_total(spark):
    rows = []
    for i in range(40):
        rows.append((f"0x{i:040x}", 1 if i < 8 else 0, "Binance" if i % 2 else "shop", 1, 0 if i % 3 else 1))
    base = spark.createDataFrame(rows, "address string, is_scam int, description string, activity_start_ts long, "
                                       "activity_end_ts long").withColumnRenamed("activity_end_ts", "is_contract") \
        .withColumn("activity_end_ts", F.lit(None).cast("long"))
    t = A.acct_balance_targets(base)
    assert t["neg_total"] == 9 and t["neg_contract"] == 4 and t["neg_eoa"] == 5
    low = A.acct_balanced(base, ensure_exch=1)
    high = A.acct_balanced(base, ensure_exch=20)
    assert low.count() == 8 + 9
    assert high.count() > low.count()
    disc = A.acct_discarded(base, high)
    assert disc.count() + high.count() == base.count()


def test_label_files_round_trip(spark, tmpdir_fresh):
    from hopweave.sources import label_files as LF
    p = os.path.join(tmpdir_fresh, "verified.csv")
    with open(p, "w") as f:
        f.write("note: exported list\n")
        f.write('"Txhash","ContractAddress","ContractName"\n')
        f.write("0x1,0xABC,Token\n0x2,0xDEF,\n")
    df = LF.read_csv_strings(spark, p, skip_first_line=True, strip_header_quotes=True)
    out = sorted(tuple(r) for r in L.lbl_verified_csv(df).collect())
    assert out == [("0xabc", 0, "Token;verified"), ("0xdef", 0, "nan;verified")]
    log = os.path.join(tmpdir_fresh, "a.log")
    a1 = "0x" + "ab" * 20
    with open(log, "w") as f:
        f.write(f"# c\n// c\n\n  {a1.upper().replace('0X', '0x')}  extra\nnot-an-address\n{a1}\n")
    got = L.lbl_text_log(LF.read_text_lines(spark, log)).collect()
    assert [(r.address, r.is_scam, r.description) for r in got] == [(a1, 1, "phishing")]
    dump = os.path.join(tmpdir_fresh, "dump.json")
    with open(dump, "w") as f:
        json.dump({"0xAA": {"name": "Fake Phishing 12", "labels": ["x"]}, "0xbb": {"name": "Exchange", "labels": []}}, f)
    d = LF.read_label_dump(spark, dump)
    empty = d.limit(0)
    kc = {r.Address: r.Label for r in L.lbl_keyword_class(d, empty).collect()}
    assert kc == {"0xaa": "Dodgy", "0xbb": "Legit"}


def test_label_dir_skips_bad_files(spark, tmpdir_fresh):
    from hopweave.sources import label_files as LF
    root = os.path.join(tmpdir_fresh, "x", "processed")
    os.makedirs(root)
    good = "0x" + "1" * 40
    with open(os.path.join(root, "a.csv"), "w") as f:
        f.write(f"address,is_scam,description\n{good},1,null\n{good.upper().replace('0X', '0x')},0,desc\n")
    with open(os.path.join(root, "b.csv"), "w") as f:
        f.write(f"addr,label\n{good},1\n")
    srcs = LF.read_label_dir(spark, LF.list_label_csvs(tmpdir_fresh))
    assert len(srcs) == 1
    m = L.lbl_merge_priority(srcs).collect()
    assert [(r.address, r.is_scam, r.description) for r in m] == [(good, 1, None)]


def test_manifest_and_verify_detect_change(spark, tmpdir_fresh):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    out = os.path.join(tmpdir_fresh, "data")
    df.write.parquet(out)
    compacted = P.pub_compact(spark, out, os.path.join(tmpdir_fresh, "compact"), rows_per_file=30)
    assert compacted.count() == 100
    files = [f for f in os.listdir(os.path.join(tmpdir_fresh, "compact")) if f.endswith(".parquet")]
    assert len(files) >= 4
    m1 = P.pub_manifest(spark, os.path.join(tmpdir_fresh, "compact"))
    listed = spark.createDataFrame(m1.collect(), m1.schema)
    victim = sorted(files)[0]
    import hashlib
    with open(os.path.join(tmpdir_fresh, "compact", victim), "rb") as f:
        body = f.read()
    row = m1.where(F.col("path") == victim).first()
    assert (row["size"], row["sha256"], row["md5"]) == (len(body), hashlib.sha256(body).hexdigest(), hashlib.md5(body).hexdigest())
    paths = {r.path for r in m1.collect()}
    assert "_SUCCESS" in paths and not any(x.startswith(".") for x in paths)
    open(os.path.join(tmpdir_fresh, "compact", "x.part"), "w").close()
    open(os.path.join(tmpdir_fresh, "compact", "new.txt"), "w").close()
    with open(os.path.join(tmpdir_fresh, "compact", victim), "ab") as f:
        f.write(b"x")
    crc = os.path.join(tmpdir_fresh, "compact", f".{victim}.crc")
    if os.path.exists(crc):  # the local filesystem's own checksum would reject the edited file first
        os.remove(crc)
    os.remove(os.path.join(tmpdir_fresh, "compact", sorted(files)[1]))
    st = {r.path: r.status for r in P.pub_verify(listed, P.pub_manifest(spark, os.path.join(tmpdir_fresh, "compact"))).collect()}
    assert st[victim] == "mismatch" and st[sorted(files)[1]] == "missing" and st["new.txt"] == "not listed" and "x.part" not in st
    assert sum(v == "ok" for v in st.values()) == len(files) - 1  # the other parts and _SUCCESS
    rep = P.pub_repack_validated(spark, out, os.path.join(tmpdir_fresh, "stg"), os.path.join(tmpdir_fresh, "fin")).first()
    assert rep.rows_in == rep.rows_out == 100 and rep.published


def test_window_nodes_ignore_null_receiver(spark):
    e = spark.createDataFrame([("0xA", None, T(2024, 1, 1), 1, 0, 1, True, "h1"),
                               ("0xA", "0xB", T(2024, 1, 8), 1, 0, 2, False, "h2")],
                              "from_address string, to_address string, timestamp timestamp, value_wei long, "
                              "tx_fee_wei long, block_number long, contract_creation boolean, tx_hash string")
    edges = W.w_edges(e)
    nodes = {r.week: r.nodes_cnt for r in W.w_window_nodes(edges, "week").collect()}
    assert nodes == {"2024-W01": 1, "2024-W02": 2}
    assert {r.month: r.nodes_cnt for r in W.w_window_nodes(edges, "month").collect()} == {"2024-01": 2}


def test_edge_stream_is_idempotent(spark, tmpdir_fresh):
    from hopweave.sources import fixtures as fx
    from hopweave.streaming.incremental import first_hop_edges, start_edge_stream
    ledger = os.path.join(tmpdir_fresh, "ledger")
    tx = fx.transactions(spark, "/root/testdata/sf0.001")
    tx.where(F.dayofmonth("block_timestamp") <= 10).write.parquet(ledger + "/part=a")
    seeds = G.g_seeds(fx.seeds(spark, "/root/testdata/sf0.001"), "2024-01-31 23:59:59")
    out = os.path.join(tmpdir_fresh, "edges")
    q = start_edge_stream(spark, ledger, seeds, out, name="t1", available_now=True)
    q.awaitTermination(120)
    tx.where(F.dayofmonth("block_timestamp") > 10).write.parquet(ledger + "/part=b")
    q = start_edge_stream(spark, ledger, seeds, out, name="t1", available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = first_hop_edges(tx, seeds)
    assert got.count() == want.count() > 0
    assert got.select("tx_hash").subtract(want.select("tx_hash")).count() == 0



def test_published_shape_identities_hold(spark):
    """Zero share of sent count equals null share of sent average; zero share of the
    burst equals null share of the hour buckets (published profile identities)."""
    from __spark_entry__ import queries
    r = queries()["q_profile_identities"](spark, "/root/testdata/sf0.001").first()
    assert r.zero_sent == r.null_sent_avg
    assert r.zero_burst == r.null_hour_bucket
    assert 0 < r.zero_burst < 1


def test_first_n_by_key_equals_ordered_limit(spark):
    df = spark.range(5000).select(F.concat(F.lit("0x"), F.col("id").cast("string")).alias("address"))
    key = C.stable_hash(F.concat(F.lit("42"), F.col("address")))
    for n in (1, 77, 4999, 6000):
        got = sorted(r.address for r in A.first_n_by_key(df, n, key).collect())
        want = sorted(r.address for r in df.orderBy(key, "address").limit(n).collect())
        assert got == want
