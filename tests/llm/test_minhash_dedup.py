"""MinHash near-dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from hopweave.llm import minhash_dedup

from .cases import documents, frame
from .test_sets_and_windows import brute_components


def found(df, **args):
    out = minhash_dedup.near_copies(df, **args)
    rows = out.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_dedup_is_brute_force(spark, n, percent):
    rows = [(r[0], r[1]) for r in documents()]
    assert found(frame(spark), n=n, percent=percent) == brute_components(rows, n, percent)


def test_one_large_group_of_near_copies(spark):
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(200):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
            w[rnd.randrange(len(w))] = rnd.choice(["q", "r", f"u{i}"])
        rows.append((i, " ".join(w[:rnd.choice([90, 90, 86, 80, 74])])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, n=3, percent=85) == brute_components(rows, 3, 85)


def test_a_third_of_all_rows_equal_and_empty_tables(spark):
    rows = [(k, "one and the same text" if k % 3 == 0 else f"text number {k} of its own {k * k}") for k in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, n=3, percent=85) == brute_components(rows, 3, 85)
    assert found(frame(spark, [])) == Counter()
    assert found(spark.createDataFrame([(1, None), (2, " "), (None, "")], "doc_id long, text string")) == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (None, 0, None): 1})


def test_partial_keys_agree_like_the_sets_do():
    rng = np.random.default_rng(4)
    for s in (0.5, 0.85):
        hits = []
        for _ in range(40):
            common = rng.integers(0, 2**63, int(400 * s), dtype=np.uint64)
            own = [rng.integers(0, 2**63, (400 - len(common)) // 2, dtype=np.uint64) for _ in range(2)]
            sets = [np.unique(np.concatenate([common, o])) for o in own]
            keys = minhash_dedup.partial_keys(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]), 12, 3)
            hits.append((keys[0] == keys[1]).mean())
        assert abs(np.mean(hits) - s**3) < 0.06
