"""Shards by a hierarchical weighted hash tree (region, rack, shard).

A row descends the tree: at every node each child draws ``-ln(u) / weight`` with ``u``
hashed from the key and the child's path, and the smallest draw wins (so a child gets
rows in proportion to its weight).  A child's draw depends on nothing but the key and its
own path and weight: when a weight changes, rows only move between that child and its
siblings, on every level, so movement stays inside subtrees whose weights change.  Added
capacity that forms a subtree of its own takes rows only into itself: the ninth shard of
``balanced_tree(9)``, a region of its own beside the two of ``balanced_tree(8)``, or any
shard added by ``grown``.

Everything is column arithmetic in the JVM; the text is reduced to its size and CRC
before anything is shuffled.

Defined results: a null key is a key like any other; a null text has size 1 and CRC 0, as
has an empty one; repeated rows get the same shard and slots of their own, in the order
of (key, CRC, size); an empty table gives no rows; only the key and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopweave.llm.common import pieces_for

#: Rows per slot bucket: the unit that is numbered in one sorted run.
BUCKET_ROWS = 50_000


@dataclass(frozen=True)
class Node:
    """A leaf carries a shard number and a weight, an inner node its children."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.leaf_weight


def balanced_tree(shards: int = 8, racks_per_region: int = 2, shards_per_rack: int = 2) -> Node:
    """Regions of racks of shards, every shard of weight 1."""
    leaves = [Node(f"s{k}", shard=k) for k in range(shards)]
    racks = [Node(f"k{k}", tuple(leaves[i:i + shards_per_rack])) for k, i in enumerate(range(0, shards, shards_per_rack))]
    regions = [Node(f"r{k}", tuple(racks[i:i + racks_per_region])) for k, i in enumerate(range(0, len(racks), racks_per_region))]
    return Node("", tuple(regions))


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    leaf = Node(f"s{shard}", shard=shard, leaf_weight=weight)
    return Node(tree.name, (*tree.children, Node(f"r+{shard}", (Node(f"k+{shard}", (leaf,)),))))


def draw(key: Column, path: str, weight: float) -> Column:
    """Exponential draw of a child, from the key and the child's path."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(path), key), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))


def shard_of(key: Column, tree: Node, path: str = "") -> Column:
    """The shard number the key's descent ends at (equal draws: the child listed first)."""
    if not tree.children:
        return F.lit(tree.shard)
    kids = [c for c in tree.children if c.weight > 0]
    if len(kids) == 1:
        return shard_of(key, kids[0], f"{path}/{kids[0].name}")
    draws = [F.struct(draw(key, f"{path}/{c.name}", c.weight).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(kids)]
    won = F.array_min(F.array(*draws))["i"]
    out = shard_of(key, kids[-1], f"{path}/{kids[-1].name}")
    for i, c in list(enumerate(kids))[-2::-1]:
        out = F.when(won == i, shard_of(key, c, f"{path}/{c.name}")).otherwise(out)
    return out


def place(docs: DataFrame, tree: Node | None = None, more: Node | None = None, key_col: str = "doc_id",
          text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row.

    Slots number the rows of a shard without gaps: rows are numbered inside hash buckets of
    bounded size, and each bucket starts where the counts of the earlier ones end.  Without a
    tree, rows lie in the eight shards of ``balanced_tree(8)`` and ``grown_shard`` is their
    shard in ``balanced_tree(9)``; a given tree grows by ``grown`` unless ``more`` is given.
    """
    more = more or (grown(tree, 1 + max(_shards(tree))) if tree else balanced_tree(9))
    tree = tree or balanced_tree()
    rows = docs.select(
        F.col(key_col), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(F.col(key_col), tree).cast("int").alias("shard"), shard_of(F.col(key_col), more).cast("int").alias("grown_shard"))
    buckets = pieces_for(docs.select(key_col).count(), bucket_rows, 4)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit("slot"), F.col(key_col), F.col("text_crc32")), F.lit(buckets)).cast("int"))
    start = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_start", F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(key_col, "text_crc32", "size")) - 1
    return rows.withColumn("_inside", inside).join(start, ["shard", "_bucket"]) \
        .select(key_col, "size", "text_crc32", "shard", (F.col("_start") + F.col("_inside")).cast("long").alias("slot"), "grown_shard")


def _shards(tree: Node) -> list[int]:
    return [tree.shard] if not tree.children else [s for c in tree.children for s in _shards(c)]
