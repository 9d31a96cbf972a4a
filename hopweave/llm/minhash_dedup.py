"""MinHash near-dedup with tensored banding, exactly confirmed.

Two texts link when ``100 * |a & b| >= percent * |a | b|`` over their sets of distinct
``n``-word shingles (A-Z read as a-z; with fewer words the whole sequence is one shingle).

1. Signatures.  One pass over the texts, in place: every text's set size, class (hash of its
   set) and two collections, left and right, of ``keys`` partial keys, each of ``rows`` minimum
   hashes.  Texts with equal sets are one class, which goes on once.
2. Tensoring.  A table's key combines one left and one right partial key: ``keys`` squared
   tables of 2 * ``rows`` hashes each come from 2 * ``keys`` * ``rows`` hash functions instead
   of 2 * ``keys`` squared * ``rows``.  A partial key that no other class has takes part in no
   shared table key, so only shared partial keys are combined.  A pair of similarity s shares
   a table with probability (1 - (1 - s^rows)^keys)^2: with the defaults all but 2.2e-5 of the
   pairs at exactly 0.85 (3.6e-4 at 0.8), fewer above it; a component needs only some of its links.
3. Confirmation.  The classes of a table key are a star around the class whose partial keys are
   the most common ones (an unedited original beats its edited copies), not all pairs; see
   ``stars``.  The full sets of classes that share a key are taken from the texts again and
   every link is verified on them.
4. Components of the confirmed links; of each the smallest id is kept.

Defined results: null, empty and blank texts have size 0, link with nothing and are kept; a
null id belongs to its class but never names it (a component of null ids only has id null, and
its rows are kept, as are all rows that repeat a kept id with an equal set); repeated rows come
out one by one; an empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopweave.llm.common import stage
from hopweave.llm.components import components
from hopweave.llm.jaccard_join import block_sets
from hopweave.llm.stars import links_of_entries
from hopweave.llm.textops import mix64, seed_of, slices

#: Partial keys a collection, and minimum hashes a partial key.
KEYS, ROWS = 12, 3

_SIGNATURE = "doc_id long, t long, n long, class long, parts array<long>"


def _class_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    marks = np.concatenate([[np.uint64(0)], np.cumsum(mix64(tokens, 0xC1A55))])
    return mix64(marks[first[1:]] - marks[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def partial_keys(tokens: np.ndarray, first: np.ndarray, keys: int, rows: int) -> np.ndarray:
    """Partial keys of every non-empty set (a line each): left ones, then right ones."""
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(some), 2 * keys), dtype=np.uint64)
    if len(some):
        for k in range(2 * keys):
            for r in range(rows):
                a, b = seed_of(7, k, r) | 1, seed_of(8, k, r)
                least = np.minimum.reduceat(tokens * np.uint64(a) + np.uint64(b), first[:-1][some])
                out[:, k] = mix64(out[:, k] + least, seed_of(9, k))
    return out


def _signatures(n: int, keys: int, rows: int):
    def signatures(batches):
        for b in batches:
            for s in slices(b.column("text")):
                own = b.slice(s.lo, s.rows)
                tokens, first = block_sets(own.column("text"), n)
                size = np.diff(first)
                at = np.concatenate([[0], np.cumsum((size > 0) * 2 * keys)]).astype(np.int32)
                flat = pa.array(partial_keys(tokens, first, keys, rows).view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("t"), pa.array(size), pa.array(_class_of(tokens, first)),
                                                  pa.ListArray.from_arrays(pa.array(at), flat)], names=["doc_id", "t", "n", "class", "parts"])
    return signatures


def table_keys(classes: DataFrame, keys: int) -> DataFrame:
    """(key, class, alone): the table keys of every class that may be shared, and ``alone``, the
    less the more common the class's partial keys are."""
    parts = classes.select("class", F.posexplode("parts").alias("k", "part")).withColumn("part", F.xxhash64("k", "part"))
    shared = parts.groupBy("part").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    kept = parts.join(shared, "part").withColumn("left", F.col("k") < keys)
    sides = kept.groupBy("class").agg(F.collect_list(F.when(F.col("left"), F.col("part"))).alias("left"),          # at most ``keys`` each
                                      F.collect_list(F.when(~F.col("left"), F.col("part"))).alias("right"), (-F.sum("often")).alias("alone"))
    return sides.select("class", "alone", F.explode("left").alias("l"), "right").select("class", "alone", "l", F.explode("right").alias("r")) \
        .select(F.xxhash64("l", "r").alias("key"), "class", "alone")


def _token_sets(n: int):
    def sets(batches):
        for b in batches:
            for s in slices(b.column("text")):
                own = b.slice(s.lo, s.rows)
                tokens, first = block_sets(own.column("text"), n)
                data = [tokens[lo:hi].tobytes() for lo, hi in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([own.column("class"), pa.array(np.diff(first)), pa.array(np.zeros(s.rows, np.int64)),
                                                  pa.array(data, pa.binary())], names=["class", "n", "alone", "tokens"])
    return sets


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80,
                keys: int = KEYS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, class, component_id, kept) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("t", F.xxhash64("text"))
    found = stage(texts.mapInArrow(_signatures(n, keys, rows), _SIGNATURE), "signatures")
    classes = found.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.min(F.struct("t", "parts")).alias("one"))
    classes = stage(classes.select("class", "least", "one.t", "one.parts"), "classes")
    entries = table_keys(classes, keys)
    entries = stage(entries.join(entries.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key"), "key"),
                    "table-keys", release=True)
    wanted = entries.select("class").distinct().join(classes.select("class", "t"), "class")
    whole = texts.select("t", "text").join(wanted, "t").dropDuplicates(["class"])
    sets = stage(whole.mapInArrow(_token_sets(n), "class long, n long, alone long, tokens binary"), "class-sets", release=True)
    roots = components(links_of_entries(entries, sets, percent)).withColumnRenamed("node", "class")
    named = classes.select("class", "least").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = stage(named.join(ids, "root").select("class", "component_id"), "class-components")
    members = found.select("doc_id", F.col("n").alias("n_shingles"), "class")
    some = members.where("n_shingles > 0").join(of_class, "class").select("doc_id", "n_shingles", "class", "component_id")
    none = members.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("class"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
