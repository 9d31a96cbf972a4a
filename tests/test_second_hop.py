"""Second-hop ranking and edges: equal to the plain rule, and without a row per seed and counterparty of a hub."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from hopweave.operators import graph as G

DAY = dt.date(2024, 1, 2)
TX = ("from_address string, to_address string, block_number long, timestamp timestamp, value_wei_raw long, gas_price_wei long, "
      "gas_used long, nonce long, input_length long, tx_hash string, day date")


def _ledger(spark, transfers):
    return spark.createDataFrame([(f, t, i, dt.datetime(2024, 1, 2, h), v, 1, 1, i, 0, f"h{i:05d}", DAY)
                                  for i, (f, t, h, v) in enumerate(transfers)], TX)


def plan_rows(df):
    """Rows that every operator of the executed plan put out."""
    df.collect()

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from walk(p.plan())
        else:
            if p.metrics().contains("numOutputRows"):
                yield p.metrics().get("numOutputRows").get().value()
            for i in range(p.children().size()):
                yield from walk(p.children().apply(i))
    return list(walk(df._jdf.queryExecution().executedPlan()))


def _plain(transfers, l1, k, batch_of):
    lists = defaultdict(list)
    for seed, near in l1:
        if near is not None:
            lists[seed, batch_of(near)].append(near)
    out = []
    for (seed, _), nears in lists.items():
        sums = defaultdict(list)
        for near in nears:
            for f, t, h, v in transfers:
                for a, b in ((f, t), (t, f)):
                    if a == near:
                        sums[b].append((v, h))
        low = -(10 ** 18)
        scored = []
        for far, rows in sums.items():
            known = [v for v, _ in rows if v is not None]
            scored.append((sum(known) if known else None, max(h for _, h in rows), far, len(rows)))
        scored.sort(key=lambda r: (-(low if r[0] is None else r[0]), -r[1], (r[2] is not None, r[2] or "")))
        out += [(seed, far, wei, h, n) for wei, h, far, n in scored[:k]]
    return sorted(out, key=str)


@pytest.mark.parametrize("far_nears", [1, 64])
@pytest.mark.parametrize("lowest", [0, -3])
def test_second_hop_equals_the_plain_rule(spark, monkeypatch, far_nears, lowest):
    """Null and repeated addresses, shared counterparties, ties, missing and negative amounts."""
    monkeypatch.setattr(G, "FAR_NEARS", far_nears)
    r = random.Random(far_nears + lowest)
    names = [f"0x{i:02d}" for i in range(12)]
    some = lambda: None if r.random() < .06 else r.choice(names[:5] if r.random() < .5 else names)
    transfers = [(some(), some(), r.randint(0, 3), r.choice([None, lowest, 0, 1, 2, 3, 4, 5, 6])) for _ in range(260)]
    l1 = [(seed, some()) for seed in names + [None] for _ in range(r.randint(0, 5))]
    first = spark.createDataFrame([(s, n, DAY) for s, n in l1], "seed_addr string, neighbor_addr string, day date")
    got = G.g_l2_topk(_ledger(spark, transfers), first, 2, scope="global").collect()
    assert sorted(((x.seed_addr, x.neighbor2_addr, x.sum_value_wei, x.last_ts.hour, x.tx_cnt) for x in got), key=str) == \
        _plain(transfers, l1, 2, lambda near: 0)


def _hub(spark):
    """A hub with 400 counterparties that 400 seeds list first, beside one neighbour of their own."""
    transfers = [("0xhub", f"0xfar{i:03d}", 1, 1000 + i) for i in range(400)] + [(f"0xown{i:03d}", f"0xfar{i:03d}", 1, 5) for i in range(400)]
    l1 = [(f"0xseed{i:03d}", n, DAY) for i in range(400) for n in ("0xhub", f"0xown{i:03d}")]
    return _ledger(spark, transfers), spark.createDataFrame(l1, "seed_addr string, neighbor_addr string, day date")


def test_seeds_of_a_hub_do_not_meet_all_its_counterparties(spark):
    tx, l1 = _hub(spark)
    ranked = G.g_l2_topk(tx, l1, 2, scope="global")
    assert max(plan_rows(ranked)) < 20_000                     # 400 x 400 before
    assert {x.neighbor2_addr for x in ranked.collect() if x.seed_addr == "0xseed005"} == {"0xfar399", "0xfar398"}


def test_edges_of_a_hub_meet_only_the_seeds_that_chose_their_end(spark):
    tx, l1 = _hub(spark)
    l2 = spark.createDataFrame([(f"0xseed{i:03d}", "0xfar399", DAY) for i in range(400)], "seed_addr string, neighbor2_addr string, day date")
    edges = G.g_e2_out(tx, l1, l2, min_wei=None)
    assert max(plan_rows(edges)) < 20_000
    assert edges.count() == 401 and edges.where("from_address = '0xhub'").distinct().count() == 1



@pytest.mark.parametrize("seeds_a_part", [1, 3, 1000])
def test_raw_second_hop_tags_every_transfer_with_every_seed(spark, seeds_a_part):
    """Null and repeated ends, self-transfers, repeated transfers, a neighbour that many seeds list; however many parts its seeds make."""
    r = random.Random(seeds_a_part)
    names = [f"0x{i}" for i in range(8)]
    some = lambda: None if r.random() < .1 else r.choice(names[:2] if r.random() < .4 else names)
    transfers = [(some(), some(), 1, 5) for _ in range(60)]
    l1 = sorted({(seed, some()) for seed in names + [None] for _ in range(4)}, key=str)
    first = spark.createDataFrame([(s, n, DAY) for s, n in l1] + [("0xother", "0x0", DAY + dt.timedelta(days=1))], "seed_addr string, neighbor_addr string, day date")
    ledger = _ledger(spark, transfers)
    want = [(f"h{i:05d}", seed) for i, (f, t, _, _) in enumerate(transfers) for end in (f, t) for seed, n in l1 if end is not None and n == end]
    key = lambda rows: sorted(rows, key=str)
    got = G.g_two_hop_raw(ledger.unionByName(ledger), first, seeds_a_part).collect()
    assert key((x.tx_hash, x.seed_addr) for x in got) == key(want + want)


def test_raw_second_hop_keeps_every_neighbour(spark, tmpdir_fresh):
    """The registered query: a seed with nine neighbours on a day has the transfers of all nine."""
    from hopweave.plans import q_graph
    rows = [(i, dt.datetime(2024, 1, 10, i), 2, "view", float(i), '{"k": %d}' % (100 + i)) for i in range(9)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmpdir_fresh}/events.parquet")
    spark.createDataFrame([(2,)], "c_custkey long").write.parquet(f"{tmpdir_fresh}/customer.parquet")
    got = q_graph.q_two_hop_raw(spark, tmpdir_fresh).collect()
    assert {x.to_address for x in got} == {"0xa" + str(100 + i).zfill(39) for i in range(9)}
    assert len(got) == 9 and {x.seed_addr for x in got} == {"0xa" + "2".zfill(39)}


def test_stages_that_nobody_asks_for_are_not_made(spark, monkeypatch):
    made = []
    monkeypatch.setattr(G, "g_l2_topk", lambda *a, **b: made.append("l2"))
    monkeypatch.setattr(G, "near_sides", lambda *a, **b: made.append("sides"))
    tx = spark.createDataFrame([("h", "0xA", "0xB", 1, dt.datetime(2024, 1, 2), 5, 1, 1, 1, "0x")],
                               "hash string, from_address string, to_address string, block_number long, block_timestamp timestamp, value long, "
                               "gas_price long, receipt_gas_used long, nonce long, input string")
    seeds = spark.createDataFrame([("0xA", dt.datetime(2024, 1, 1), None)], "address string, activity_start_ts timestamp, activity_end_ts timestamp")
    s = G.build_graph(tx, seeds, "2024-01-31 23:59:59", k1=None)
    assert G.g_two_hop_raw(s["txd"], s["l1"]).count() == 1 and not made
