"""Plan-shape checks for the scale design (as planned for large inputs: no automatic broadcasts)."""

import re

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_auto_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    from hopweave.plans import q_graph
    q_graph.MATERIALIZE = False
    yield spark
    q_graph.MATERIALIZE = True
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _tree(spark, name):
    from __spark_entry__ import queries
    df = queries()[name].raw(spark, SF)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    phys = plan.split("== Physical Plan ==")[1]
    body, details = phys.split("\n\n")[0], phys.split("\n\n")[1:]
    info = {}
    for block in details:
        m = re.match(r"\((\d+)\) ", block.strip())
        if m:
            info[m.group(1)] = block
    nodes = []
    for line in body.splitlines()[1:]:
        i = line.find("+- ")
        if i >= 0:
            text = line[i + 3:].strip()
            m = re.search(r"\((\d+)\)$", text)
            nodes.append((i, text, info.get(m.group(1), "") if m else ""))
    return nodes


def _ancestors(nodes, idx):
    depth, out = nodes[idx][0], []
    for j in range(idx - 1, -1, -1):
        if nodes[j][0] < depth:
            out.append(nodes[j][1])
            depth = nodes[j][0]
    return out


@pytest.mark.parametrize("name", ["p_keep_weeks", "d_final"])
def test_dense_day_table_is_never_shuffled(no_auto_broadcast, name):
    nodes = _tree(no_auto_broadcast, name)
    # the generators that expand one row per account into one row per day
    gens = [i for i, (_, n, d) in enumerate(nodes) if n.startswith("Generate") and "sequence(" in d]
    assert gens
    for i in gens:
        assert not any(a.startswith("Exchange") for a in _ancestors(nodes, i)), name


def test_top_k_is_limited_before_its_shuffle(no_auto_broadcast):
    nodes = _tree(no_auto_broadcast, "g_l1_topk")
    names = [n for _, n, _ in nodes]
    w = next(i for i, n in enumerate(names) if n.startswith("Window "))
    assert names[w + 1].startswith("WindowGroupLimit")
    assert names[w + 2].startswith("Exchange") or names[w + 3].startswith("Exchange")
    assert any(n.startswith("BroadcastHashJoin") for n in names)  # first hop: no ledger shuffle
