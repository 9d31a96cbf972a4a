"""Links inside groups of candidate sets, without writing out a group's pairs.

A group (all entries of a key) is a star around one centre; stars with the same centre are one.
What is linked is connected, in three steps:

* Every member is verified against the centre of its largest star: a pair per member.  A star
  all of whose members are connected by then needs nothing more.
* In the other stars members of different components are compared in pieces of bounded size.
  Of the pairs whose marks allow a link, first only the closest ones that would connect the
  star's components are verified,
* then, between components that are still apart, all of them.

A mark holds, for every cell of a hashed universe, whether the set has an odd number of tokens
in it.  Cells in which two marks differ hold a difference each, so their number never exceeds
the differences of the sets: pairs above ``differ`` cannot link.  Marks are a small part of the
tokens, and only pairs that they allow are verified on whole sets.

Large stars are dealt anew first, by other hashes and among their members only: sets that met by
chance part, and linked ones meet again.

Sets are (class, n, alone, tokens): n distinct tokens, ``alone`` of them known to be in no other
set and left out of ``tokens`` (0 if nothing is known).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopweave.functions.common import sized_broadcast
from hopweave.llm.common import stage
from hopweave.llm.components import components
from hopweave.llm.textops import mix64, seed_of

#: Members of a star that are compared with one another in one group.
PIECE_MEMBERS = 512
#: Open members from which a star is dealt anew.
LARGE_STAR = 64
#: Cells of a mark for each difference that linked sets may have: of as many differences about
#: one in this number goes unseen.
CELLS = 16
#: Classes that are sent to every executor to pick their sets.
BROADCAST_ROWS = 100_000


def differ(r: int, s: int, percent: int) -> int:
    """The most shingles in which linked sets of sizes r and s differ."""
    return r + s - 2 * -(-percent * (r + s) // (100 + percent))


def most_apart(low: int, high: int, percent: int) -> int:
    """The most differences of two linked sets whose sizes add up to ``low`` .. ``high``.

    One more shingle in the sum changes the bound by one, up or down, and it rises on the
    whole: the last two sums hold the largest.
    """
    return max(t - 2 * -(-percent * t // (100 + percent)) for t in range(max(low, high - 1), high + 1))


def _stars(entries: DataFrame) -> DataFrame:
    """(centre, member) of every key with more than one member: one row per member."""
    centre = entries.groupBy("key").agg(F.min(F.struct("alone", "class")).alias("_c"), F.min("class").alias("_a"), F.max("class").alias("_z")) \
        .where("_a < _z").select("key", F.col("_c.class").alias("centre"))
    return entries.join(centre, "key").where("class <> centre").select("centre", F.col("class").alias("member")).distinct()


# -- exact verification ----------------------------------------------------------------------

def _linked(percent: int):
    """Pairs whose sets link (both reduced to shingles that repeat)."""
    def linked(batches):
        for b in batches:
            n = b.column("a_n").to_numpy() + b.column("b_n").to_numpy()
            lone = b.column("a_alone").to_numpy() + b.column("b_alone").to_numpy()
            apart = np.zeros(b.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(b.column("a_tokens"), b.column("b_tokens"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                apart[k] = len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True))
            apart += lone
            at = pa.array(np.flatnonzero(100 * (n - apart) >= percent * (n + apart)))
            yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in ("a", "b")], names=["a", "b"])
    return linked


def _sides(pairs: DataFrame, sets: DataFrame, data: str) -> DataFrame:
    """Pairs with n, alone and ``data`` of both sets.  Both sides read one shuffle of the sets."""
    side = lambda s: sets.select(F.col("class").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "alone", data)])
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs (a written table) that link."""
    classes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    some = sets.join(sized_broadcast(classes, BROADCAST_ROWS), "class", "left_semi")
    return _sides(pairs, some, "tokens").mapInArrow(_linked(percent), "a long, b long")


# -- marks -----------------------------------------------------------------------------------

def mark_of(tokens: np.ndarray, n: int, percent: int) -> bytes:
    """The parity of a set's tokens in each cell; twice the cells, the same cells cut in two."""
    reach = most_apart(2 * n, n + n * 100 // percent, percent)
    size = 1 << max(6, (CELLS * reach - 1).bit_length())
    odd = np.bincount((mix64(tokens, seed_of(77)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _marks(percent: int):
    def marks(batches):
        for b in batches:
            data = [mark_of(np.frombuffer(t.as_buffer(), np.uint64), n, percent) for t, n in zip(b.column("tokens"), b.column("n").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("n"), b.column("alone"), pa.array(data, pa.binary())],
                                             names=["class", "n", "alone", "mark"])
    return marks


def _folded(marks: list[bytes]) -> np.ndarray:
    """Marks as rows of words, all cut to the fewest cells among them."""
    least = min(map(len, marks))
    out = np.zeros((len(marks), least // 8), np.uint64)
    for k, m in enumerate(marks):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(m, np.uint64).reshape(-1, least // 8), axis=0)
    return out


def near_pairs(marks: list[bytes], n: np.ndarray, alone: np.ndarray, root: np.ndarray, part: np.ndarray, percent: int):
    """(x, y, differences seen) of rows of different components that may link by their marks;
    rows of two parts are compared across the parts only."""
    words, xs, ys, seen = _folded(marks), [], [], []
    cross = len(np.unique(part)) > 1
    for x in range(len(n) - 1):
        y = np.arange(x + 1, len(n))
        y = y[(root[y] != root[x]) & ((part[y] != part[x]) if cross else True)]
        if not len(y):
            continue
        apart = np.bitwise_count(words[y] ^ words[x]).sum(1, dtype=np.int64) + alone[y] + alone[x]
        total = n[y] + n[x]
        ok = np.maximum(apart, np.abs(n[y] - n[x])) <= total - 2 * -(-percent * total // (100 + percent))
        xs.append(np.full(int(ok.sum()), x))
        ys.append(y[ok])
        seen.append(apart[ok])
    cat = lambda v: np.concatenate(v) if v else np.zeros(0, np.int64)
    return cat(xs), cat(ys), cat(seen)


def _allowed(percent: int):
    """Pairs that may link by their marks."""
    def allowed(batches):
        for b in batches:
            n, alone = (np.stack([b.column(f"a_{c}").to_numpy(), b.column(f"b_{c}").to_numpy()], 1) for c in ("n", "alone"))
            two, ids = np.arange(2), zip(b.column("a_mark").to_pylist(), b.column("b_mark").to_pylist(), strict=True)
            ok = [len(near_pairs(list(m), n[k], alone[k], two, two, percent)[0]) > 0 for k, m in enumerate(ids)]
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in ("a", "b")], names=["a", "b"])
    return allowed


def _closest(x: np.ndarray, y: np.ndarray, seen: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Positions of the closest pairs that connect all components the pairs connect."""
    above, out = {}, []

    def top(r):
        while above.get(r, r) != r:
            above[r] = above.get(above[r], above[r])
            r = above[r]
        return r

    for k in np.argsort(seen, kind="stable").tolist():
        a, b = top(int(root[x[k]])), top(int(root[y[k]]))
        if a != b:
            above[a] = b
            out.append(k)
    return np.array(out, np.int64)


def _candidates(percent: int, every: bool):
    """(a, b): pairs of one piece of a star that may link; the closest ones, or every one."""
    def candidates(t):
        member, root, n, alone, part = (t.column(c).to_numpy() for c in ("member", "root", "n", "alone", "part"))
        x, y, seen = near_pairs(t.column("mark").to_pylist(), n, alone, root, part, percent)
        if not every:
            at = _closest(x, y, seen, root)
            x, y = x[at], y[at]
        a, b = member[x], member[y]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return candidates


def _open_members(stars: DataFrame, roots: DataFrame) -> DataFrame:
    """(centre, member, root, open) of stars that hold more than one component; the centre is a member."""
    members = stars.unionByName(stars.select("centre", F.col("centre").alias("member")).distinct())
    rows = members.join(roots.select(F.col("node").alias("member"), "root"), "member", "left").withColumn("root", F.coalesce("root", "member"))
    star = rows.groupBy("centre").agg(F.count(F.lit(1)).alias("open"), F.min("root").alias("_a"), F.max("root").alias("_z"))
    return rows.join(star.where("_a < _z").select("centre", "open"), "centre").select("centre", "member", "root", "open")


def _near(rows: DataFrame, marks: DataFrame, percent: int, every: bool) -> DataFrame:
    """(a, b): pairs of open members of a star that may link; every two parts of a star meet once."""
    parts = rows.withColumn("_parts", F.ceil(F.col("open") / PIECE_MEMBERS).cast("int")) \
        .withColumn("part", F.pmod(F.xxhash64("member"), F.col("_parts")).cast("int"))
    pieces = parts.join(marks.withColumnRenamed("class", "member"), "member") \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))) \
        .withColumn("i", F.least("part", "_other")).withColumn("j", F.greatest("part", "_other"))
    return pieces.select("centre", "i", "j", "member", "root", "n", "alone", "mark", "part") \
        .groupBy("centre", "i", "j").applyInArrow(_candidates(percent, every), "a long, b long").distinct()


def _as_links(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _connected(stars: DataFrame, known: DataFrame, sets: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """``known`` (node, root) and what the links between open members of the stars connect."""
    tested = None
    for every in (False, True):
        rows = stage(_open_members(stars, known), "open-members")
        pairs = _near(rows, marks, percent, every)
        pairs = stage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs", release=True)
        count = pairs.count()
        if not count:
            break
        links = stage(_verified(pairs, sets, percent), "near-links", release=True)
        found = links.count()
        if found:
            known = stage(components(_as_links(known).unionByName(links)), "components")
        if found == count:      # the closest pairs connect all that the marks allow to
            break
        tested = pairs
    return known


def links_of_entries(entries: DataFrame, sets: DataFrame, percent: int,
                     again: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """(a, b): pairs that connect exactly what the links between entries of a key connect.

    ``entries``: (key, class, alone), of a key the one with the least (alone, class) is the centre;
    ``sets``: one row per class, in a written table.  ``again(sets, level)`` gives new entries, by
    other hashes, in which linked sets meet as well: members of large stars are dealt anew
    among themselves while at most half of the sets are in such stars.
    """
    marks = stage(sets.mapInArrow(_marks(percent), "class long, n long, alone long, mark binary"), "marks")
    known, dealt, level = None, sets, 0
    while True:
        stars = stage(_stars(entries), "stars", release=True)
        if known is None:
            sizes = stars.groupBy("centre").agg(F.count(F.lit(1)).alias("_size"))
            best = stars.join(sizes, "centre").groupBy("member").agg(F.max(F.struct("_size", "centre"))["centre"].alias("centre"))
            best = _sides(best.select(F.col("centre").alias("a"), F.col("member").alias("b")), marks, "mark")
            best = stage(best.mapInArrow(_allowed(percent), "a long, b long"), "best-pairs")
            known = stage(components(stage(_verified(best, sets, percent), "best-links", release=True)), "components")
        fewer = None
        if again is not None:
            large = stage(_open_members(stars, known).where(F.col("open") > LARGE_STAR).select("centre", F.col("member").alias("class")), "large-stars")
            if not large.isEmpty():
                fewer = stage(dealt.join(large.select("class").distinct(), "class", "left_semi"), "open-sets")
                if 2 * fewer.count() <= dealt.count():
                    stars = stars.join(large.select("centre").distinct(), "centre", "left_anti")
                else:
                    fewer = None
        known = _connected(stars, known, sets, marks, percent)
        if fewer is None:
            return _as_links(known).where("a <> b")
        dealt, level = fewer, level + 1
        entries = again(fewer, level)
