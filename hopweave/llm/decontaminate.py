"""Benchmark decontamination: size-partitioned MinHash containment search.

A document leaks a test item when it holds at least ``percent`` of the item's distinct
five-word shingles (words: runs of letters and digits, lower-cased; an item of fewer words
is one shingle).  Documents are far longer than items, so their resemblance is tiny and
equal-sized sketches would miss them; containment is searched from the item's side instead:

1. Items fall into size partitions.  An item's sketch is its bottom-k MinHash (the k
   shingles with the smallest hashes), k = size - ceil(percent * size) + 1 by its size: a
   document without any of them lacks more than the item may miss, so none is lost.
2. Every document's shingles probe the sketches; a document smaller than what an item of
   that partition asks for is not a candidate.
3. Candidates are verified: distinct shingles shared with the item over the item's size.

Column functions only.  The sketches are broadcast when a count proves them small (so the
documents' shingles are probed where they are made, without a shuffle), else joined.

Defined results: null, empty and wordless items are never leaked, and such documents leak
nothing; repeated items match one by one; rows that repeat an id are taken together (each
text is judged on its own, a pair is listed once with its largest share); a null document
id is reported as null; empty tables give no rows.  Only ids and texts are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopweave.functions.common import sized_broadcast
from hopweave.llm.common import stage

SHINGLE = 5
#: Sketch rows (24 bytes each) that may be broadcast.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(of: Column, length: int) -> Column:
    """Hashes of all windows of ``length`` words (none if there are fewer)."""
    return F.when(F.size(of) >= length, F.transform(
        F.sequence(F.lit(0), F.size(of) - length),
        lambda i: F.xxhash64(F.lit(length), *[F.get(of, i + k) for k in range(length)])))


def _item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, length, h): distinct shingles of every item; ``item`` numbers rows by content."""
    rows = items.select(F.col(id_col).alias("item_id"), words(F.coalesce(F.col(text_col), F.lit(""))).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("item", F.xxhash64(F.col("item_id"), F.array_join("w", " "))).dropDuplicates(["item"]) \
        .withColumn("length", F.least(F.size("w"), F.lit(SHINGLE)))
    hashes = F.lit(None)
    for k in range(1, SHINGLE + 1):
        hashes = F.when(F.col("length") == k, shingles(F.col("w"), k)).otherwise(hashes)
    return rows.select("item", "item_id", "length", F.explode(F.array_distinct(hashes)).alias("h"))


def _leaked(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, percent: int) -> DataFrame:
    """(doc_id, t, item, item_id, n_item, n_shared) of every leaked pair; t: the text's hash."""
    wanted = stage(_item_shingles(items, item_col, item_text_col), "item-shingles")
    lengths = [r["length"] for r in wanted.select("length").distinct().collect()]          # at most SHINGLE values
    sizes = wanted.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    need = F.ceil(F.col("n_item") * percent / F.lit(100))
    low = F.row_number().over(Window.partitionBy("item").orderBy("h"))                    # an item is one document long
    sketches = wanted.join(sizes, "item").withColumn("rank", low).withColumn("need", need) \
        .where(F.col("rank") <= F.col("n_item") - F.col("need") + 1)
    # size partitions by powers of two; a partition's least need bounds the documents probed
    part = F.floor(F.log2("n_item"))
    sketches = sketches.withColumn("part", part)
    least = sketches.groupBy("part").agg(F.min("need").alias("least"))
    sketches = stage(sketches.join(least, "part").select("h", "item", "least"), "item-sketches")

    key = [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("t")]
    texts = docs.where(F.col(text_col).isNotNull()).select(*key, words(F.col(text_col)).alias("w"))
    hashes = F.concat(*[F.coalesce(shingles(F.col("w"), k), F.array().cast("array<long>")) for k in sorted(lengths)]) if lengths \
        else F.array().cast("array<long>")
    probes = texts.select("doc_id", "t", F.size("w").alias("n_words"), F.explode(hashes).alias("h"))
    found = stage(probes.join(sized_broadcast(sketches, BROADCAST_ROWS), "h").where("n_words >= least")
                  .select("doc_id", "t", "item").distinct(), "leak-candidates")
    again = docs.where(F.col(text_col).isNotNull()).select(*key, F.col(text_col).alias("text")) \
        .join(found.select(F.col("doc_id").alias("d"), F.col("t").alias("u")).distinct(),
              F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u")), "left_semi") \
        .select("doc_id", "t", words(F.col("text")).alias("w")).dropDuplicates(["doc_id", "t"]) \
        .select("doc_id", "t", F.explode(F.array_distinct(hashes)).alias("h"))
    pairs = found.select(F.col("doc_id").alias("d"), F.col("t").alias("u"), "item").join(wanted, "item")
    shared = again.join(pairs, (again["h"] == pairs["h"]) & again["doc_id"].eqNullSafe(F.col("d")) & (again["t"] == F.col("u"))) \
        .groupBy("doc_id", "t", "item", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))
    return shared.join(sizes, "item").where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every leaked pair."""
    return _leaked(docs, items, id_col, text_col, item_col, item_text_col, percent) \
        .groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("c"), "n_shared", "n_item")).alias("b")) \
        .select("doc_id", "item_id", F.col("b.n_item").alias("n_item"), F.col("b.n_shared").alias("n_shared"), F.col("b.c").alias("containment"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text leaks no item."""
    bad = _leaked(docs, items, id_col, text_col, item_col, item_text_col, percent) \
        .select(F.col("doc_id").alias("_bad_id"), F.col("t").alias("_bad_t")).distinct()
    return docs.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.col(text_col)) == F.col("_bad_t")), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x : x <> '') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x : x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
bs AS (SELECT DISTINCT item_id, s FROM (
  SELECT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i:i + 4], ' ')) END) AS s FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i : array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM d, lengths WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
h AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM h JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 80
"""
