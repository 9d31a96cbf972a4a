"""Nearest neighbours, decontamination and quotation linking against brute force or SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hopweave.llm import decontaminate, nearest, quotation

from .cases import documents, frame


def brute_nearest(rows, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            at = np.flatnonzero(ids != i)
            s = (x[at] * q).sum(1)
            out[int(i)] = [int(ids[at][j]) for j in np.lexsort((ids[at], -s))[:k]]
    return out


def test_nearest_recall_and_ties(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(8, 24))
    rows = [(i, list(map(float, centres[i % 8] + rnd.normal(size=24)))) for i in range(3000)]
    rows += [(3000 + i, rows[40][1]) for i in range(50)]                # a common vector: ties go to smaller ids
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, block_rows=700, query_rows=64).collect()
    want, found = brute_nearest(rows, 20), {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(found) == set(want)
    assert np.mean([len(set(found[q]) & set(w)) / 20 for q, w in want.items()]) >= 0.9
    assert found[40] == want[40] == [*range(3000, 3020)]


def test_nearest_edges(spark):
    one = [1.0, 0.0, 0.5]
    rows = [(0, one), (20, one), (20, one), (1, [2.0, 1.0, 0.0]), (2, None), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 1.0]), (5, [float("nan"), 1.0, 1.0]),
            (6, [float("inf"), 1.0, 1.0]), (7, [1.0]), (None, one), (8, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest.search(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1, 1, 2.0), (0, 2, 20, 1.25), (20, 1, 1, 2.0), (20, 2, 0, 1.25)}
    assert nearest.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rnd = np.random.default_rng(0)
    codes = rnd.integers(0, 256, (2000, 4), dtype=np.uint8)
    index = nearest.MultiIndex(codes)
    for radius in (0, 3, 7, 11, 32):
        apart = np.unpackbits(codes ^ codes[0], axis=1).sum(1)
        assert list(index.within(codes[0], radius)) == list(np.flatnonzero(apart <= radius))


def brute_leaks(docs, items, percent=80):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    grams = lambda w, n: {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    out = set()
    for item, text in items:
        w = words(text)
        own = grams(w, min(5, len(w))) if w else set()
        for doc, t in docs:
            shared = len(own & grams(words(t), min(5, len(w)))) if own else 0
            if own and shared * 100 >= len(own) * percent:
                out.add((doc, item, len(own), shared))
    return out


def test_leaks_are_brute_force(spark):
    rnd = random.Random(6)
    rows = documents(seed=8)
    items = []
    for k in range(25):
        w = (rows[rnd.randrange(50)][1]).split()
        part = w[:rnd.choice([2, 4, 5, 9, 30])]
        if k % 3 == 0 and len(part) > 6:
            part[len(part) // 2] = "changed"
        items.append((k, " ".join(part).upper() if k % 4 == 0 else ", ".join(part)))
    items += [(30, None), (31, ""), (32, "!!"), (33, items[0][1]), (33, items[0][1])]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in decontaminate.leaks(frame(spark, rows), df).collect()}
    assert got and got == brute_leaks([(r[0], r[1]) for r in rows], items)
    clean = decontaminate.without_leaks(frame(spark, rows), df)
    bad = {(d, t) for d, t in ((r[0], r[1]) for r in rows) if brute_leaks([(d, t)], items)}
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == Counter((r[0], r[1]) for r in rows if (r[0], r[1]) not in bad)
    assert decontaminate.leaks(frame(spark, []), df).count() == 0
    assert decontaminate.leaks(frame(spark, rows), df.where("false")).count() == 0
    assert decontaminate.without_leaks(frame(spark, rows), df.where("false")).count() == len(rows)


def test_quotes_are_the_sql(spark):
    rnd = random.Random(3)
    lines = ["hello  World", "How are you?", "fine thanks", "x y z", "the end", "Bye  now"]
    rows = [(c, t, "u", "\n".join(rnd.choice(["", "> ", ">> ", "> > ", ""]) + rnd.choice(lines) for _ in range(rnd.randint(0, 5))))
            for c in range(30) for t in range(rnd.randint(1, 8))]
    pdf = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    con = duckdb.connect()
    con.register("conversations", pdf)
    cur = con.execute(quotation.ORACLE)
    names = [d[0] for d in cur.description]
    want = Counter(tuple(r) for r in cur.fetchall())
    got = quotation.link_quotes(spark.createDataFrame(pdf)).select(*names).collect()
    assert Counter(tuple(r) for r in got) == want


def test_quotes_by_hand(spark):
    rows = [(1, 0, "u", "Hello there my Friend\nHow are you?\nbye"), (1, 1, "a", "> how are  you?\nFine."), (1, 2, "u", "see\n>> How are you?\n> Fine.\nGood"),
            (2, 0, "u", "> Hello there my friend how are you? bye\n\nFrom elsewhere"), (2, 1, "x", None), (None, 1, "q", "> Fine."), (1, 1, "a", "again")]
    df = spark.createDataFrame([(*r, "other") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = {(r["conv_id"], r["turn"], r["parent_conv"], r["parent_turn"], r["linked_by"], r["thread_conv"], r["depth"], r["quote_levels"], r["text"])
           for r in quotation.link_quotes(df).collect()}
    assert got == {(1, 0, None, None, None, 1, 0, 0, rows[0][3]), (1, 1, 1, 0, "quote", 1, 1, 1, "Fine."), (1, 1, 1, 0, "quote", 1, 1, 0, "again"),
                   (1, 2, 1, 1, "quote", 1, 2, 2, "see\nGood"), (2, 0, 1, 0, "quote", 1, 1, 1, "From elsewhere"), (2, 1, 2, 0, "turn", 1, 2, 0, ""),
                   (None, 1, None, None, None, None, 0, 1, "")}
    assert quotation.link_quotes(df.where("false")).count() == 0


def test_long_chain_and_hub(spark):
    rows = [(1, t, "u", f"m{t}") for t in range(150)] + [(2, t, "u", "> m3") for t in range(60)]
    got = {(r["conv_id"], r["turn"]): (r["thread_conv"], r["thread_turn"], r["depth"])
           for r in quotation.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {**{(1, t): (1, 0, t) for t in range(150)}, **{(2, t): (1, 0, 4) for t in range(60)}}
