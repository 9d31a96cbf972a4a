"""Interaction audit of five text filters over a sparse document-term matrix.

A document fails filter
    A  with fewer than 200 words (maximal runs of bytes other than space and 0x09-0x0D),
    B  when 100 * distinct words < 50 * words (case-sensitive),
    C  when 100 * letters A-Z > 3 * code points,
    D  when it holds any of ``#$%&*|``,
    E  when its text equals that of any smaller id.
The filters are applied in all 120 orders, and for every part (value of ``lang``), order and
step the audit counts what each filter removes.

1. Shards.  Every task cuts its texts into shards of bounded bytes.  A shard is a sparse
   matrix in CSR form (row pointers, column codes, counts) over a word list of its own; the
   flags C and D and a 128-bit hash of the text are taken in the same pass.  No text is shuffled.
2. Dictionary.  A shard lists its words in buckets by hash (a word that every text holds is
   listed once a shard, not once a text).  A bucket gathers the lists of all shards, numbers its
   distinct words in order (a word's global number: rank and bucket) and answers every list;
   back at their shard the numbers replace its own codes.  Lists are never more than the words
   listed, a bucket holds about BUCKET_WORDS of them.
3. Row sums of the matrix are the words of A, nonzero counts the distinct words of B.
4. E without a join of the texts: equal rows are counted per id, then per text, part, flags and
   labels with the smallest id beside the count; the smallest id of a text then splits each
   of these few rows into copies that pass and copies that fail.
5. What is left are counts per part and set of failed filters (at most 32 sets and four label
   pairs a part); each row takes its place in the 600 steps.

Defined results: a null text is the empty text, a null ``lang`` the empty part; a null id is
never smaller or larger than another, so such a row never fails E, and it has no label; rows
that repeat an id count one by one, with equal text they do not make one another fail; a
document is good (toxic) when any of its label rows says quality = 1 (toxic = 1); an empty
table gives no rows.  Other columns are not read.  A text is one row of a shard, however long.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopweave.llm.common import pieces_for, source_bytes, stage
from hopweave.llm.textops import row_counts, slices, span_hashes, word_strings, words_of

FILTERS = "ABCDE"
#: Bytes of text in a shard (a longer text is a shard of its own).
SHARD_BYTES = 8 << 20
#: Listed words that are numbered at once (at most 2^24 buckets).
BUCKET_WORDS = 500_000

_DOC = ["doc_id", "part", "t1", "t2"]
_DOC_SQL = "doc_id: bigint, part: string, t1: bigint, t2: bigint, c: boolean, d: boolean"
#: Row pointers, codes and counts are little-endian 32-bit numbers (``first``: 64-bit).
_SHARD = f"shard long, docs array<struct<{_DOC_SQL}>>, first binary, codes binary, counts binary, lists array<struct<bucket: int, words: binary>>"
_SIGNS = np.isin(np.arange(256), list(b"#$%&*|"))


def _list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _bytes(values: np.ndarray, kind: str) -> pa.Array:
    return pa.array([values.astype(kind).tobytes()], pa.binary())


def _numbers(column, kind: str) -> np.ndarray:
    return np.frombuffer(column[0].as_buffer(), kind)


def _word_lists(words: pa.StringArray, buckets: int) -> tuple[np.ndarray, pa.Array]:
    """The bucket-wise order of a shard's words, and per bucket its words, a line each."""
    joined = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    bucket = (span_hashes(joined, ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    text = words.take(pa.array(order)).to_pylist()
    lines = ["\n".join(text[lo:hi]).encode() for lo, hi in zip(at, [*at[1:], len(order)], strict=True)]
    return order, pa.StructArray.from_arrays([pa.array(used, pa.int32()), pa.array(lines, pa.binary())], names=["bucket", "words"])


def _shard(number: int, batch: pa.RecordBatch, s, buckets: int) -> pa.RecordBatch:
    w = words_of(s)
    coded = word_strings(s, w).dictionary_encode()
    size = max(1, len(coded.dictionary))
    order, lists = _word_lists(coded.dictionary, buckets)
    code = np.empty(size, dtype=np.int64)
    code[order] = np.arange(len(order))
    cell, count = np.unique(w.row * size + code[coded.indices.to_numpy()], return_counts=True)
    first = np.searchsorted(cell, np.arange(s.rows + 1) * size)
    upper = row_counts((s.data >= 65) & (s.data <= 90), s.offsets)
    points = row_counts((s.data & 0xC0) != 0x80, s.offsets)
    signs = row_counts(_SIGNS[s.data], s.offsets)
    own = [batch.column(n).slice(s.lo, s.rows) for n in _DOC]
    docs = pa.StructArray.from_arrays([*own, pa.array(100 * upper > 3 * points), pa.array(signs > 0)], names=[*_DOC, "c", "d"])
    columns = [pa.array([number], pa.int64()), _list(docs), _bytes(first, "<i8"), _bytes(cell % size, "<i4"), _bytes(count, "<i4"), _list(lists)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "docs", "first", "codes", "counts", "lists"])


def _shards(shard_bytes: int, buckets: int):
    def shards(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for s in slices(b.column("text"), shard_bytes):
                yield _shard(number, b, s, buckets)
                number += 1
    return shards


def csr_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
               shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Texts as CSR shards over their own word lists, in a written table."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text, F.octet_length(text)).alias("t2"), text.alias("text"))
    buckets = pieces_for(source_bytes(docs, text_col)[1] // 12, BUCKET_WORDS, 16)
    return stage(rows.mapInArrow(_shards(shard_bytes, buckets), _SHARD), "csr-shards")


def _number(t):
    """(word, number in its bucket) of every word of a bucket's lists, list by list."""
    s = next(slices(t.column("words").combine_chunks(), 1 << 62))
    w = words_of(s)
    coded = word_strings(s, w).dictionary_encode()
    rank = np.empty(len(coded.dictionary), dtype=np.int64)
    rank[pc.array_sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    return coded, rank[coded.indices.to_numpy()], w.first


def _number_lists(t):
    """The numbers of every list's words: the same word has the same one wherever it is listed."""
    _, rank, first = _number(t)
    kind = "<i4" if not len(rank) or rank.max() < 2**31 else "<i8"
    return pa.table({"shard": t.column("shard"), "bucket": t.column("bucket"), "wide": pa.array([kind == "<i8"] * t.num_rows),
                     "ranks": pa.array([rank[lo:hi].astype(kind).tobytes() for lo, hi in zip(first[:-1], first[1:], strict=True)], pa.binary())})


def _number_words(t):
    coded, rank, _ = _number(t)
    low, at = np.unique(rank, return_index=True)
    return pa.table({"word": coded.dictionary.take(coded.indices.take(pa.array(at))), "id": pa.array((low << 24) + t.column("bucket")[0].as_py())})


def _lists(shards: DataFrame) -> DataFrame:
    return shards.select("shard", F.explode("lists").alias("x")).select("shard", "x.bucket", "x.words")


def dictionary(shards: DataFrame) -> DataFrame:
    """(word, id): the global number of every word of the shards."""
    return _lists(shards).groupBy("bucket").applyInArrow(_number_words, "word string, id long")


def _global_rows(shard: pa.Table, numbers: pa.Table):
    """Row pointers, column numbers (ascending in a row) and counts of a shard."""
    first, codes, counts = (_numbers(shard.column(c), k) for c, k in (("first", "<i8"), ("codes", "<i4"), ("counts", "<i4")))
    ids = [np.zeros(0, np.int64)]
    for r in sorted(numbers.select(["bucket", "wide", "ranks"]).to_pylist(), key=lambda r: r["bucket"]):
        ids.append((np.frombuffer(r["ranks"], "<i8" if r["wide"] else "<i4").astype(np.int64) << 24) + r["bucket"])
    row, column = np.repeat(np.arange(len(first) - 1), np.diff(first)), np.concatenate(ids)[codes]
    order = np.lexsort((column, row))
    return first, column[order], counts[order]


def _matrix(shard, numbers):
    first, column, counts = _global_rows(shard, numbers)
    return pa.table({"shard": shard.column("shard"), "docs": shard.column("docs"), "first": _list(pa.array(first, pa.int64())),
                     "columns": _list(pa.array(column, pa.int64())), "counts": _list(pa.array(counts, pa.int32()))})


def _figures(shard, numbers):
    """One row per document: row sum and nonzero count of its matrix row, and its flags."""
    first, _, counts = _global_rows(shard, numbers)
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[first]
    docs = shard.column("docs").combine_chunks().flatten()
    return pa.Table.from_arrays([*docs.flatten(), pa.array(np.diff(total)), pa.array(np.diff(first))], names=[*_DOC, "c", "d", "n_words", "n_distinct"])


_MATRIX = f"shard long, docs array<struct<{_DOC_SQL}>>, first array<long>, columns array<long>, counts array<int>"
_ROWS = "doc_id long, part string, t1 long, t2 long, c boolean, d boolean, n_words long, n_distinct long"


def _of_shards(shards: DataFrame, make, schema: str) -> DataFrame:
    numbers = _lists(shards).groupBy("bucket").applyInArrow(_number_lists, "shard long, bucket int, wide boolean, ranks binary")
    return shards.drop("lists").groupBy("shard").cogroup(numbers.groupBy("shard")).applyInArrow(make, schema)


def document_term_matrix(shards: DataFrame) -> DataFrame:
    """CSR shards over global column numbers (``dictionary`` tells their words)."""
    return _of_shards(shards, _matrix, _MATRIX)


def _orders():
    """An array of all (filter_order, step, bit of the step's filter, bits of the earlier ones)."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = []
    for order in map("".join, permutations(FILTERS)):
        for k, f in enumerate(order):
            steps.append(F.struct(F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bit[f]).alias("bit"),
                                  F.lit(sum(bit[g] for g in order[:k])).alias("before")))
    return F.array(*steps)


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the set of filters that they fail (bit 0: A)."""
    rows = _of_shards(csr_shards(docs, id_col, text_col, part_col, shard_bytes), _figures, _ROWS)
    flags = [F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"), F.col("c"), F.col("d")]
    rows = rows.withColumn("mask", sum((f.cast("int") * (1 << k) for k, f in enumerate(flags[1:], 1)), flags[0].cast("int")))
    same = ["t1", "t2", "part", "mask"]
    rows = stage(rows.groupBy("doc_id", *same).agg(F.count(F.lit(1)).alias("n")), "failures")
    says = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    known = rows.where(F.col("doc_id").isNotNull()).join(told, "doc_id", "left").fillna(0, ["good", "toxic"])
    unknown = rows.where(F.col("doc_id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    # of each text: copies per part, flags and labels, with the copies of the smallest id among them
    alike = known.unionByName(unknown).groupBy(*same, "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"))
    least = F.min("low.doc_id").over(Window.partitionBy("t1", "t2"))      # rows: parts x label pairs
    passing = F.col("unnamed") + F.when(F.col("low.doc_id") == F.col("least"), F.col("low.n")).otherwise(0)
    two = F.array(F.struct(F.col("mask"), F.col("passing").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))
    return alike.withColumn("least", least).withColumn("passing", passing) \
        .select("part", "good", "toxic", F.explode(two).alias("x")).select("part", "x.mask", "good", "toxic", "x.n").where("n > 0") \
        .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    counts = stage(failure_counts(docs, labels, id_col, text_col, part_col, shard_bytes), "failure-counts")
    rows = counts.withColumn("s", F.explode(_orders())).select("part", "mask", "good", "toxic", "n", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    # over all orders, a document goes to each of the k filters it fails in 120 / k of them
    share = F.col("n") * F.element_at(F.array(*[F.lit(120 // k) for k in (1, 2, 3, 4, 5)]), F.greatest(F.bit_count("mask"), F.lit(1)))
    total = lambda condition, value="n": F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value).otherwise(0))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"), total(gone & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(~gone & fails & (F.col("good") == 1)).alias("good_lost"),
        total(~gone & fails & (F.col("toxic") == 1)).alias("toxic_lost"), total(fails, share).alias("shapley"))


ORACLE = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
said AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS e
      FROM w LEFT JOIN said ON said.doc_id = w.doc_id),
long AS (SELECT part, good, toxic, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS v),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.v, q.v, r.v, s.v, t.v] AS bits FROM l p, l q, l r, l s, l t
           WHERE p.v + q.v + r.v + s.v + t.v = 31 AND len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, step::INT AS step, bits[step] AS bit, list_sum(list_concat([0], bits[1:step - 1])) AS before FROM orders, range(1, 6) r(step)),
m AS (SELECT part, filter_order, step, bit, n, good, toxic, mask, (mask & bit) <> 0 AS fails, (mask & before::INT) <> 0 AS gone FROM long, steps),
sums AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER (NOT gone AND fails AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (NOT gone AND fails AND toxic), 0)::BIGINT AS toxic_lost
  FROM m GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM sums
"""
