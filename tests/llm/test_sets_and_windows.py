"""N-gram Jaccard join and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from hopweave.llm import jaccard_join, stars, substring_dedup
from hopweave.llm.components import components

from .cases import documents, fold, frame


def shingles(text, n):
    w = fold(text)
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1))


def brute_components(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [j for m, (j, _) in enumerate(sets) if find(m) == find(k) and j is not None] if s else [i]
        out.append((i, len(s), min(ids, default=None)))
    return Counter(out)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_join_is_brute_force(spark, n, percent):
    rows = [(r[0], r[1]) for r in documents()]
    out = jaccard_join.join_components(frame(spark), n=n, percent=percent, block_bytes=3000, segment_keys=500)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert got == brute_components(rows, n, percent)


def test_join_one_large_group_of_near_copies(spark):
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
            w[rnd.randrange(len(w))] = rnd.choice(["q", "r", f"u{i}"])
        rows.append((i, " ".join(w[:rnd.choice([90, 90, 88, 84])])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(df).collect())
    assert got == brute_components(rows, 4, 85)


def test_sets_that_met_a_centre_by_chance_are_dealt_anew(spark):
    rnd = random.Random(11)
    sets = []
    for _ in range(30):
        base = rnd.sample(range(1 << 40), 60)
        for _ in range(3):
            own = set(base)
            for t in rnd.sample(base, rnd.randrange(5)):
                own.discard(t)
            sets.append(own)
    alone = [set(rnd.sample(range(1 << 40), 40)) for _ in range(150)]
    rows = [(k, len(x), 0, bytearray(b"".join(t.to_bytes(8, "little") for t in sorted(x)))) for k, x in enumerate([*sets, *alone])]
    table = spark.createDataFrame(rows, "class long, n long, alone long, tokens binary")
    one_key = spark.createDataFrame([(1, k, 0) for k in range(len(sets))], "key long, class long, alone long")
    levels = []

    def again(fewer, level):
        levels.append((level, fewer.count()))
        return jaccard_join.indexed(fewer, 85, level)

    links = stars.links_of_entries(one_key, table, 85, again).collect()
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        assert 100 * len(sets[r["a"]] & sets[r["b"]]) >= 85 * len(sets[r["a"]] | sets[r["b"]])
        root[find(r["a"])] = find(r["b"])
    for a in range(len(sets)):
        for b in range(a):
            linked = 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
            assert not linked or find(a) == find(b)
    assert levels and levels[0][0] == 1 and levels[0][1] > 60


def test_tickets_cover_every_linked_pair():
    for low, high in ((1, 1), (6, 7), (20, 23), (100, 117)):
        band = jaccard_join.allot(low, high, 85, 1000)
        assert band.plain + 2 * band.double == band.apart + 1
        for s in range(low, high + 1):
            for r in range(s, s * 100 // 85 + 1):
                assert stars.differ(r, s, 85) <= band.apart


def test_most_apart_is_the_maximum():
    for percent in (60, 80, 85, 93):
        for low in range(2, 60):
            for high in range(low, 140):
                assert stars.most_apart(low, high, percent) == max(stars.differ(t, 0, percent) for t in range(low, high + 1))


def test_one_of_each_keeps_the_smallest_id_and_wordless_rows(spark):
    rows = [(3, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "z y x w v u"), (4, None), (5, " "), (None, "z y x w v u")]
    out = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(r["doc_id"] for r in out.collect()) == Counter([1, 2, 4, 5])


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert jaccard_join.join_components(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_components_are_smallest_reachable(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}


def brute_removed(rows, n):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    first = {}
    place = lambda k, s: ((rows[k][0] is not None, rows[k][0] or 0), s)
    words = [(t or "").encode().split() for _, t in rows]
    for k in order:
        for s in range(len(words[k]) - n + 1):
            key = tuple(words[k][s:s + n])
            first[key] = min(first.get(key, place(k, s)), place(k, s))
    out = []
    for k, (i, _) in enumerate(rows):
        gone = [False] * len(words[k])
        for s in range(len(words[k]) - n + 1):
            if first[tuple(words[k][s:s + n])] < place(k, s):
                gone[s:s + n] = [True] * n
        left = [w for w, g in zip(words[k], gone, strict=True) if not g]
        out.append((i, len(words[k]), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("n", [20, 5])
def test_windows_are_brute_force(spark, n):
    rows = [(r[0], r[1]) for r in documents(seed=4)]
    out = substring_dedup.remove_repeats(frame(spark, documents(seed=4)), n=n, keep=("doc_id", "source", "removed"), block_bytes=4000, segment_windows=700)
    assert out.columns == ["doc_id", "source", "n_words", "n_removed", "removed", "kept_text"]
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in out.collect())
    assert got == brute_removed(rows, n)


def test_spans_and_untouched_texts(spark):
    passage = " ".join(f"p{k}" for k in range(25))
    rows = [(1, f"a  b\n{passage}"), (2, f"c {passage} d"), (3, "left\n as  it is")]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), untouched=True)
    got = {r["doc_id"]: (r["kept_text"], [(x["start"], x["end"]) for x in r["removed"]]) for r in out.collect()}
    assert got == {1: (rows[0][1], []), 2: ("c d", [(1, 26)]), 3: (rows[2][1], [])}


@pytest.mark.parametrize("edges", [[], [(5, 5)], [(k, k + 1) for k in range(40)], [(1, 2), (2, 1), (2, 1), (9, 2), (7, 8)],
                                   [(100, k) for k in range(50)] + [(100, -3), (60, 61)]])
def test_components_are_those_of_union_find(spark, edges):
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(got) == sorted((x, find(x)) for x in root)


def test_chains_of_links_across_stars_are_one_component(spark):
    """Neighbours on a chain link, its ends share nothing; what connects them is handed on as components."""
    sets = [set(range(k * 3, k * 3 + 60)) for k in range(40)]
    rows = [(k, len(x), 0, bytearray(b"".join(t.to_bytes(8, "little") for t in sorted(x)))) for k, x in enumerate(sets)]
    table = spark.createDataFrame(rows, "class long, n long, alone long, tokens binary")
    one_key = spark.createDataFrame([(1, k, 0) for k in range(len(sets))], "key long, class long, alone long")
    links = stars.links_of_entries(one_key, table, 85, lambda fewer, level: jaccard_join.indexed(fewer, 85, level))
    assert {(r["node"], r["root"]) for r in components(links).collect()} == {(k, 0) for k in range(len(sets))}
