"""Links inside stars: what is written, and what marks may rule out."""

import random

import numpy as np

from hopweave.llm import stars


def as_rows(sets):
    return [(k, len(x), 0, bytearray(b"".join(t.to_bytes(8, "little") for t in sorted(x)))) for k, x in enumerate(sets)]


def near_misses(rnd, count, size, changed):
    """Sets around one base, none of which links with another: each lacks and adds its own tokens."""
    base = rnd.sample(range(1 << 40), size)
    return [set(base) - set(rnd.sample(base, changed)) | set(rnd.sample(range(1 << 40), changed)) for _ in range(count)]


def test_a_star_of_near_misses_is_not_written_as_differences_or_pairs(spark, monkeypatch):
    rnd = random.Random(3)
    sets = near_misses(rnd, 50, 120, 8)
    sets += [sets[7] - set(sorted(sets[7])[:3]), sets[9] | {1}]                     # two that link, not with the centre
    table = spark.createDataFrame(as_rows(sets), "class long, n long, alone long, tokens binary")
    one_key = spark.createDataFrame([(1, k, 0) for k in range(len(sets))], "key long, class long, alone long")
    written, plain = [], stars.stage

    def counted(df, name, release=False):
        out = plain(df, name, release)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(stars, "stage", counted)
    links = {frozenset((r["a"], r["b"])) for r in stars.links_of_entries(one_key, table, 85).collect()}
    assert links == {frozenset((7, 50)), frozenset((9, 51))}
    assert max(written, key=lambda x: x[1])[1] <= 2 * len(sets), written


def test_pieces_of_a_star_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(stars, "PIECE_MEMBERS", 7)
    rnd = random.Random(8)
    sets = near_misses(rnd, 40, 100, 8)
    sets += [x - set(sorted(x)[:4]) for x in sets[::3]] + [x - set(sorted(x)[5:9]) for x in sets[::2]]
    table = spark.createDataFrame(as_rows(sets), "class long, n long, alone long, tokens binary")
    one_key = spark.createDataFrame([(1, k, 0) for k in range(len(sets))], "key long, class long, alone long")
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in stars.links_of_entries(one_key, table, 85).collect():
        root[find(r["a"])] = find(r["b"])
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                assert find(a) == find(b)
    assert len({find(k) for k in range(len(sets))}) == 40


def test_marks_never_rule_out_a_link():
    rnd = random.Random(4)
    for percent in (60, 80, 85):
        for _ in range(200):
            a = set(rnd.sample(range(1 << 40), rnd.randint(1, 150)))
            b = set(rnd.sample(sorted(a), rnd.randint(len(a) * 4 // 5, len(a)))) | set(rnd.sample(range(1 << 40), rnd.randint(0, 1 + len(a) // 9)))
            marks = [stars.mark_of(np.array(sorted(s), np.uint64), len(s), percent) for s in (a, b)]
            x, _, seen = stars.near_pairs(marks, np.array([len(a), len(b)]), np.zeros(2, np.int64), np.arange(2), np.zeros(2), percent)
            assert len(x) or 100 * len(a & b) < percent * len(a | b)
            assert not len(x) or seen[0] <= len(a ^ b)
