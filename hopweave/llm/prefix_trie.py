"""Trie of conversation prefixes, built by van Emde Boas recursion.

Conversations are ordered by turn and rebuilt: with b = c - c % 20 and h = crc32(decimal c) % 4,
conversation c is the first h turns of b, then its own turns after its first h.  Every distinct
sequence of first d turns (role, text) is a node of depth d.

1. Order.  Turns are sorted by range of (conversation, turn), so a long conversation spreads
   over partitions; a turn's position is its place in the partition's run plus the lengths of
   the conversation's earlier runs.  Then a turn is two 64-bit hashes and a word count.
2. Blocks.  Aligned blocks of 1, 2, 4, ... turns are named from their halves.
3. Cuts.  A sequence of height 2^k is cut at half depth; the cut prefix is named from the name
   it starts under and the block of 2^(k-1) turns.  The upper halves and the lower halves
   (the latter under their cut names) are then cut the same way, all at once, down to single
   turns.  Rows double from level to level, so all levels cost about two rows a turn.
4. Nodes.  Equal names are one node; its key is (smallest member, depth).
5. Totals.  Below a node with one member hangs a chain with one leaf and no tokens saved, so
   only shared nodes are summed.  Tries of height 2^k hold the totals of their roots; a lower
   trie's root total is grafted onto the root of the upper trie it hangs under (heights 1, 2,
   4, ...), and on the way back onto the cut roots in between, until every node has the
   totals of its whole subtree.  Again a few rows a node for all levels.
6. Digests.  Conversations that end at a node are sorted by range and written out as pieces of
   text in parallel; a node's pieces are hashed in order, streamed, never gathered.

Defined results: a null turn comes first; turns of one number follow role, then text; null role
or text is empty; rows without a conv_id belong to no conversation; a conversation whose turns
all fall away is a member of the root alone; an empty table gives no rows; other columns are
not read.  Names compare turns by 128 bits of hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hopweave.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
#: Levels planned in one go between written tables.
LEVELS = 4
#: Bytes of a piece of a digest's text.
PIECE_BYTES = 1 << 20
_ROOT = (0x5EED, 0xF00D)


def _named(*parts) -> list:
    return [F.xxhash64(F.lit(k), *parts) for k in (1, 2)]


# -- order and rebuilding ----------------------------------------------------------------------

def _ordered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(c, p, m, x, y, w) of every turn in a written table, and its runs (c, p, m0, before, n)."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"),
                                                           filled(role_col).alias("role"), filled(text_col).alias("text"))
    rows = rows.repartitionByRange("c", F.asc_nulls_first("turn"), F.substring("role", 1, 32)) \
        .sortWithinPartitions("c", F.asc_nulls_first("turn"), "role", "text")
    x, y = _named("role", "text")
    rows = rows.select("c", F.monotonically_increasing_id().alias("m"), x.alias("x"), y.alias("y"),
                       F.regexp_count("text", F.lit(WORD)).cast("long").alias("w"))
    rows = stage(rows, "turns").withColumn("p", F.shiftright("m", 33))
    runs = rows.groupBy("c", "p").agg(F.min("m").alias("m0"), F.count(F.lit(1)).alias("n"))
    # a conversation has at most a run per partition
    return rows, runs.withColumn("before", F.sum("n").over(Window.partitionBy("c").orderBy("p")) - F.col("n"))


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(c, i, x, y, w): the turns of all rebuilt conversations, and (c, total): their lengths."""
    rows, runs = _ordered(turns, conv_col, turn_col, role_col, text_col)
    convs = runs.groupBy("c").agg(F.sum("n").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % 4).withColumn("b", F.col("c") - F.col("c") % 20)
    of_base = convs.select(F.col("c").alias("b"), F.col("n").alias("bn"))
    convs = convs.join(of_base, "b", "left").withColumn("took", F.least("h", F.coalesce("bn", F.lit(0))))
    convs = stage(convs.select("c", "b", "h", "took", (F.col("took") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "conversations")
    placed = runs.join(convs.select("c", "h", "took"), "c").select("c", "p", "h", "took", (F.col("before") - F.col("m0")).alias("shift"))
    own = rows.join(placed, ["c", "p"]).withColumn("i", F.col("m") + F.col("shift"))
    heads = own.where((F.col("i") < 3) & (F.col("c") % 20 == 0)).select(F.col("c").alias("b"), "i", "x", "y", "w")
    heads = heads.join(convs.select("c", "b", "h"), "b").where("i < h").select("c", "i", "x", "y", "w")
    rest = own.where("i >= h").select("c", (F.col("i") - F.col("h") + F.col("took")).alias("i"), "x", "y", "w")
    return stage(rest.unionByName(heads), "rebuilt"), convs.select("c", "total")


# -- names by recursive cuts -------------------------------------------------------------------

def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k: (c, j, bx, by), the names of full blocks of 2^k turns."""
    out = [turns.select("c", F.col("i").alias("j"), F.col("x").alias("bx"), F.col("y").alias("by"))]
    for k in range(1, levels):
        odd = F.col("j") % 2 == 1
        half = [F.max(F.when(side, F.col(c))).alias(f"{c}{n}") for n, side in enumerate((~odd, odd)) for c in ("bx", "by")]
        pair = out[-1].groupBy("c", F.shiftright("j", 1).alias("k")).agg(*half, F.count(F.lit(1)).alias("n")).where("n = 2")
        x, y = _named("bx0", "by0", "bx1", "by1")
        out.append(stage(pair.select("c", F.col("k").alias("j"), x.alias("bx"), y.alias("by")), "blocks"))
    return out


def prefix_names(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(c, d, x, y): the name of every prefix of every sequence, the empty one included."""
    longest = lengths.agg(F.max("total")).first()[0] or 0
    levels = int(longest).bit_length()                # depths 0 .. longest lie below 2^levels
    blocks = _blocks(turns, levels)
    names = lengths.select("c", F.lit(0).cast("long").alias("j"), F.lit(_ROOT[0]).cast("long").alias("x"), F.lit(_ROOT[1]).cast("long").alias("y"))
    for k in range(levels - 1, -1, -1):
        # the cut of a sequence of height 2^(k+1): its first 2^k turns, if it has them
        x, y = _named("x", "y", "bx", "by")
        cut = F.struct((F.col("j") + 1).alias("j"), x.alias("x"), y.alias("y"))
        start = F.struct("j", "x", "y")
        names = names.withColumn("j", F.col("j") * 2).join(blocks[k], ["c", "j"], "left") \
            .select("c", F.explode(F.when(F.col("bx").isNull(), F.array(start)).otherwise(F.array(start, cut))).alias("s")).select("c", "s.*")
        if k and (levels - k) % LEVELS == 0:
            names = stage(names, "cuts")
    return stage(names.withColumnRenamed("j", "d"), "names")


# -- totals by grafting ------------------------------------------------------------------------

_SUMS = ("leaves", "saved")


def _grafted(base: DataFrame, roots: DataFrame, distance: int) -> DataFrame:
    """``base`` with the sums of the roots whose ancestor ``distance`` above is the row's node."""
    sums = roots.groupBy(F.col("u").alias("c"), (F.col("d") - distance).alias("d")).agg(*[F.sum(s).alias(f"_{s}") for s in _SUMS])
    more = base.join(sums, ["c", "d"], "left")
    return more.withColumns({s: F.col(s) + F.coalesce(f"_{s}", F.lit(0)) for s in _SUMS}).drop(*[f"_{s}" for s in _SUMS])


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(c, d, leaves, saved) summed over every node's subtree.

    ``nodes``: (c, d, u, leaves, saved) in a written table; u: the parent's c (its depth is d - 1).
    """
    deepest = nodes.agg(F.max("d")).first()[0]
    levels = int(deepest or 0).bit_length()
    tries = [nodes]                                   # level k: roots at depths that are multiples of 2^k
    for k in range(levels):
        lower = tries[k].where(F.shiftright("d", k) % 2 == 1)
        upper = _grafted(tries[k].where(F.shiftright("d", k) % 2 == 0), lower, 1 << k)
        above = lower.select(F.col("c").alias("u"), (F.col("d") + (1 << k)).alias("d"), F.col("u").alias("_u"))
        upper = upper.join(above, ["u", "d"], "left").select("c", "d", F.col("_u").alias("u"), *_SUMS)
        tries.append(stage(upper, f"tries-{k}"))
    whole = tries[levels].select("c", "d", *_SUMS)
    for k in range(levels - 1, -1, -1):
        below = whole.join(tries[k].where("d > 0").select("c", "d", "u"), ["c", "d"])
        cut = _grafted(tries[k].where(F.shiftright("d", k) % 2 == 1).drop("u"), below, 1 << k)
        whole = stage(whole.unionByName(cut.select(*whole.columns)), f"totals-{k}")
    return whole


# -- digests -----------------------------------------------------------------------------------

def _pieces(batches):
    """Runs of one node's sorted ids as text."""
    for b in batches:
        x, y, c = (b.column(n).to_numpy() for n in ("x", "y", "c"))
        if not len(c):
            continue
        new = np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        step = max(1, PIECE_BYTES // 21)
        starts = sorted({0, *new.tolist(), *range(0, len(c), step)})
        texts = [",".join(map(str, c[lo:hi].tolist())) for lo, hi in zip(starts, [*starts[1:], len(c)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x[starts]), pa.array(y[starts]), pa.array(c[starts]), pa.array(texts)], names=["x", "y", "c", "piece"])


def _hashed(batches):
    """One digest a node from its pieces, which come one after another."""
    key, state = None, None
    for b in batches:
        rows = zip(b.column("x").to_pylist(), b.column("y").to_pylist(), b.column("piece"), strict=True)
        done = []
        for x, y, piece in rows:
            if (x, y) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (x, y), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_buffer())
        yield _digests(done)
    if key is not None:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows) -> pa.RecordBatch:
    x, y, d = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(d, pa.string())], names=["x", "y", "ends"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(x, y, ends): SHA-256 of each node's ids ``c``, ascending, joined by commas."""
    pieces = ends.select("x", "y", "c").repartitionByRange("x", "y", "c").sortWithinPartitions("x", "y", "c") \
        .mapInArrow(_pieces, "x long, y long, c long, piece string")
    return pieces.repartition("x", "y").sortWithinPartitions("x", "y", "c").mapInArrow(_hashed, "x long, y long, ends string")


# -- the trie ----------------------------------------------------------------------------------

def trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, lengths = rebuilt(turns, conv_col, turn_col, role_col, text_col)
    names = prefix_names(rows, lengths)
    nodes = names.groupBy("x", "y").agg(F.min("c").alias("c"), F.max("d").alias("d"), F.count(F.lit(1)).alias("n"))
    last = rows.select("c", (F.col("i") + 1).alias("d"), "w")
    parent = names.select("c", (F.col("d") + 1).alias("d"), F.col("x").alias("px"), F.col("y").alias("py"))
    nodes = stage(nodes.join(last, ["c", "d"], "left").join(parent, ["c", "d"], "left"), "nodes")
    owner = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("c").alias("u"))
    nodes = nodes.join(owner, ["px", "py"], "left").drop("px", "py")
    nodes = stage(nodes.withColumn("own", F.coalesce((F.col("n") - 1) * F.col("w"), F.lit(0))).drop("w"), "tree")
    kids = nodes.where("d > 0").groupBy(F.col("u").alias("c"), (F.col("d") - 1).alias("d")) \
        .agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n") == 1).alias("chains"))
    nodes = stage(nodes.join(kids, ["c", "d"], "left").fillna(0, ["n_children", "chains"]), "tree")
    leaves = F.col("chains") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    shared = nodes.where("n > 1").select("c", "d", "u", leaves.alias("leaves"), F.col("own").alias("saved"))
    totals = subtree_totals(stage(shared, "shared"))
    ends = ends_digest(lengths.select("c", F.col("total").alias("d")).join(names, ["c", "d"]))
    return nodes.join(totals, ["c", "d"], "left").join(ends, ["x", "y"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("u").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


# CRC-32 is spelt out: a table of 256 steps, then a byte at a time.
ORACLE = r"""
WITH steps AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda c, k : CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(i))),
own AS (SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT own.*, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda s : ascii(s)::BIGINT)),
    lambda a, b : xor(tab[(xor(a, b) & 255) + 1], a >> 8))) % 4 AS h FROM own, steps),
built AS (SELECT cut.c, list_concat(coalesce(base.turns, [])[:h], cut.turns[h + 1:]) AS turns FROM cut LEFT JOIN own base ON base.c = cut.c - cut.c % 20),
spot AS (SELECT c, d, turns[:d] AS seq, len(turns) = d AS ends, len(regexp_extract_all(turns[d].text, '[^\x20\x09-\x0D]+')) AS w
       FROM built, range(0, (SELECT coalesce(max(len(turns)), 0) + 1 FROM built)) r(d) WHERE d <= len(turns)),
node AS (SELECT seq, d, min(c) AS c, count(*) AS n, (count(*) - 1) * coalesce(any_value(w), 0) AS own,
       sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM spot GROUP BY seq, d),
kids AS (SELECT seq[:d - 1] AS seq, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kids ON kids.seq = node.seq),
sums AS (SELECT a.d, a.seq, sum((b.k = 0)::INT)::BIGINT AS n_leaves, sum(b.own)::BIGINT AS saved_tokens
       FROM full_node a JOIN (SELECT k, own, unnest(list_transform(range(0, d + 1), lambda e : seq[:e])) AS up FROM full_node) b ON b.up = a.seq GROUP BY a.d, a.seq)
SELECT f.c AS conv_id, f.d AS depth, p.c AS parent_conv_id, f.n AS n_convs, f.k AS n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM full_node f JOIN sums s ON s.seq = f.seq LEFT JOIN node p ON f.d > 0 AND p.seq = f.seq[:f.d - 1]
"""
