"""Repeated passages: a distributed count-min prefilter, then exact grouping.

A window is ``n`` consecutive words of one document.  A word goes when a window covers it
whose word sequence also starts earlier (at a smaller id, or earlier in the same document).

1. Documents are dealt to blocks of bounded size by the hash of their id and text, so rows
   that share an id (or have none) are spread.  Exact copies, id and text, that would fill
   half a block are judged as one row and joined with its result.  Every block
   builds a count-min sketch (two rows of saturating counters) of its windows, cut into
   segments by window hash, and sends each segment's non-zero counters.
2. Per segment the blocks' sketches are merged.  The merged counters only overestimate,
   so a window whose two counters are not both 2 or more occurs once.  Every block gets
   back one bit per counter it sent - no merged sketch is ever held whole, broadcast or
   sent to the driver, and its width grows with the number of windows.
3. Windows that may repeat are grouped exactly: by two independent 64-bit hashes.  A block
   sends the earliest of each of its sequences only (so a passage that fills a third of
   all rows is one row per block) and gets back which of them are the earliest of all.
4. Words covered by any other window go.

Between the steps only byte strings of counters, hashes and bits are shuffled; the text is
shuffled once, by block.

Defined results: null and empty texts have no words and nothing removed; a document shorter
than a window loses nothing; rows that repeat an id are judged as copies at the same place
(none is earlier than the other, both lose what starts earlier elsewhere); a null id counts
as smaller than any other; an empty table gives no rows.  Only the id, text and ``keep``
columns are read; a kept column named like an output column is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.llm.block_sketch import REPLY, SEGMENT_KEYS, SKETCH, by_segment, estimated_repeats, merge_sketches, sketch_of, told
from hopweave.llm.common import pieces_for, stage
from hopweave.llm.textops import mix64, ngram_hashes, slices, word_hashes, words_of

WINDOW = 20
#: Text bytes per block: with the windows per segment they bound a task's memory.  Their
#: number of pairs is the number of messages; beyond some 10 TB raise both.
BLOCK_BYTES = 12 << 20
#: What a row counts besides its text when copies are weighed.
ROW_BYTES = 64

_OUT = ["n_words", "n_removed", "removed", "kept_text"]


def _block_windows(texts, n: int):
    """All windows of a block's texts: hash, second hash, row, first word in the row."""
    h1, h2, rows, starts = [], [], [], []
    for s in slices(texts):
        w = words_of(s)
        h = word_hashes(s, w)
        a, begin = ngram_hashes(h, w.first, n)
        if len(a):
            b, _ = ngram_hashes(mix64(h, 0xB10C), w.first, n, seed=0x2ED)
            row = np.repeat(np.arange(s.rows), np.diff(begin))
            h1.append(a)
            h2.append(b)
            rows.append(row + s.lo)
            starts.append(np.arange(len(a)) - begin[row])
    if not h1:
        z = np.zeros(0, np.uint64)
        return z, z, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in (h1, h2, rows, starts))


def _sketch(segments: int, n: int):
    def sketch(t):
        h, *_ = _block_windows(t.column("text"), n)
        return sketch_of(h, t.column("block")[0].as_py(), segments)
    return sketch


def _candidates(docs, replies, segments: int, n: int):
    """(docs in id order, windows, and of the windows that may repeat: position, whether it is
    later than the block's first of its sequence, position among the block's firsts)."""
    docs = docs.sort_by([("key", "ascending")])
    h1, h2, row, start = _block_windows(docs.column("text"), n)
    key = docs.column("key").to_numpy()
    maybe = estimated_repeats(h1, replies, segments)
    at = np.flatnonzero(maybe)
    order = at[np.lexsort((start[at], key[row[at]], h2[at], h1[at]))]
    same = np.zeros(len(order), dtype=bool)                   # same sequence as the one before
    same[1:] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
    group = np.cumsum(~same) - 1
    lead = order[~same]
    later = (key[row[order]] != key[row[lead]][group]) | (start[order] != start[lead][group])
    return docs, key, (h1, h2, row, start), order, group, lead, later


def _group_exactly(segments: int, n: int):
    def firsts(docs, replies):
        _, key, (h1, h2, row, start), _, _, lead, _ = _candidates(docs, replies, segments, n)
        ks, data, sizes = [], [], []
        for k, at in by_segment(h1[lead], segments):
            own = lead[at]
            ids, count = np.unique(key[row[own]], return_counts=True)
            own = own[np.argsort(key[row[own]], kind="stable")]
            ks.append(k)
            sizes.append(len(own))
            data.append(len(ids).to_bytes(4, "little") + ids.tobytes() + count.astype("<u4").tobytes() + h1[own].tobytes() + h2[own].tobytes()
                        + start[own].astype("<u4").tobytes())
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        return pa.table({"segment": pa.array(ks, pa.int32()), "block": pa.array([block] * len(ks), pa.int32()),
                         "n": pa.array(sizes, pa.int32()), "data": pa.array(data, pa.binary())})
    return firsts


def _find_first(t):
    """Of all blocks' firsts of a segment, which are the first of all: the smallest id and start
    of their sequence, in several blocks if rows repeat the id."""
    ids, h1, h2, starts, sizes = [], [], [], [], t.column("n").to_numpy()
    for n, x in zip(sizes, t.column("data"), strict=True):
        x = x.as_buffer()
        docs = int.from_bytes(memoryview(x)[:4], "little")
        at = 4
        own = np.frombuffer(x, "<i8", docs, at)
        count = np.frombuffer(x, "<u4", docs, at + 8 * docs)
        at += 12 * docs
        ids.append(np.repeat(own, count))
        h1.append(np.frombuffer(x, "<u8", n, at))
        h2.append(np.frombuffer(x, "<u8", n, at + 8 * n))
        starts.append(np.frombuffer(x, "<u4", n, at + 16 * n))
    ids, h1, h2, starts = (np.concatenate(x) for x in (ids, h1, h2, starts))
    order = np.lexsort((starts, ids, h2, h1))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])
    least = order[new][np.cumsum(new) - 1]
    flag = np.empty(len(order), dtype=bool)
    flag[order] = (ids[order] == ids[least]) & (starts[order] == starts[least])
    cut = np.concatenate([[0], np.cumsum(sizes)])
    bits = [np.packbits(flag[x:y]).tobytes() for x, y in zip(cut, cut[1:], strict=False)]
    return pa.table({"block": t.column("block"), "kind": pa.array([1] * t.num_rows, pa.int32()), "segment": t.column("segment"),
                     "a": pa.array(bits, pa.binary()), "b": pa.array([None] * t.num_rows, pa.binary())})


def _finish(segments: int, n: int, keep: list[str], untouched: bool):
    def finish(docs, replies):
        docs, key, (h1, _, row, start), order, group, lead, later = _candidates(docs, replies, segments, n)
        first_of_all = np.zeros(len(lead), dtype=bool)
        bits = told(replies, 1)
        for k, at in by_segment(h1[lead], segments):
            at = at[np.argsort(key[row[lead[at]]], kind="stable")]
            first_of_all[at] = np.unpackbits(np.frombuffer(bits[k]["a"], np.uint8), count=len(at)).astype(bool)
        gone = order[later | ~first_of_all[group]]
        cut = np.searchsorted(row[np.sort(gone)], np.arange(docs.num_rows + 1)) if len(gone) else np.zeros(docs.num_rows + 1, np.int64)
        gone = np.sort(gone)                                  # windows are in row order
        n_words, n_removed, spans, kept = [], [], [], []
        for r, text in enumerate(docs.column("text")):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            at = start[gone[cut[r]:cut[r + 1]]]
            runs = []
            if len(at):
                breaks = np.flatnonzero(np.diff(at) > n)
                for x, y in zip(at[np.concatenate([[0], breaks + 1])], at[np.append(breaks, len(at) - 1)], strict=True):
                    runs.append((int(x), int(y) + n))
                left, end = [], 0
                for x, y in runs:
                    left += words[end:x]
                    end = y
                left += words[end:]
            else:
                left = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            spans.append([{"start": x, "end": y} for x, y in runs])
            kept.append(text.as_py() if untouched and not runs else b" ".join(left).decode())
        out = [docs.column(c) for c in keep]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([*out, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                        names=[*keep, *_OUT])
    return finish


def _copies(docs: DataFrame, id_col: str, text_col: str, heavy: int) -> tuple[int, DataFrame | None]:
    """Text bytes of a table, and the (key, t, u, n) of rows that are so many (n) copies of one id and text
    that they weigh ``heavy`` bytes or more (None without any)."""
    each = docs.select(*_identity(id_col, text_col), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("b")) \
        .groupBy("key", "t", "u").agg(F.count("*").alias("n"), F.sum("b").alias("b"))
    many = (F.col("n") > 1) & (F.col("b") + ROW_BYTES * F.col("n") >= heavy)
    r = each.agg(F.sum("b").alias("b"), F.max(many).alias("many")).first()
    return int(r["b"] or 0), stage(each.where(many).select("key", "t", "u", "n"), "copies") if r["many"] else None


def _identity(id_col: str, text_col: str) -> list[Column]:
    """Id and two hashes of the text (a null text has none of another's)."""
    text = F.col(text_col)
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key"),
            F.xxhash64(F.lit("text"), text.isNull(), text).alias("t"), F.xxhash64(F.lit("copy"), text.isNull(), text).alias("u")]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep=("doc_id",), n: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES, segment_windows: int = SEGMENT_KEYS, untouched: bool = False) -> DataFrame:
    """``keep`` columns plus n_words, n_removed, removed (word spans) and kept_text of every row.

    kept_text is the kept words with one blank between; with ``untouched``, a text that loses
    nothing is returned as it came.
    """
    keep = [c for c in keep if c not in _OUT]
    size, copies = _copies(docs, id_col, text_col, block_bytes // 2)
    blocks, segments = pieces_for(size, block_bytes, 16), pieces_for(size // 6, segment_windows)
    rows = docs.select(*_identity(id_col, text_col), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)])
    kept = [f"keep_{k}" for k in range(len(keep))]
    if copies is None:
        return _judge(rows, kept, blocks, segments, n, untouched).withColumnsRenamed(dict(zip(kept, keep, strict=True)))
    same, own = ["key", "t", "u"], [rows.schema[c].dataType for c in kept]
    copied = rows.join(F.broadcast(copies), same)                       # at most two a block
    one = copied.groupBy(*same).agg(F.min("text").alias("text")).select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(kept, own, strict=True)])
    marks = ["copied", "key", "t", "u"]
    judged = stage(_judge(rows.join(F.broadcast(copies), same, "left_anti").withColumn("copied", F.lit(False))
                          .unionByName(one.withColumn("copied", F.lit(True))), [*kept, *marks], blocks, segments, n, untouched), "judged")
    out = judged.where(~F.col("copied")).drop(*marks)
    shares = F.least(F.col("n"), F.lit(64)).cast("int")                 # the result is repeated no more often than the row
    spread = judged.where("copied").drop("copied", *kept).join(F.broadcast(copies), same).withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("n")
    again = copied.select(*same, *kept, F.pmod(F.spark_partition_id(), shares).alias("share")).join(spread, [*same, "share"]).drop(*same, "share")
    return out.unionByName(again).withColumnsRenamed(dict(zip(kept, keep, strict=True)))


def _judge(rows: DataFrame, kept: list[str], blocks: int, segments: int, n: int, untouched: bool) -> DataFrame:
    """``kept`` columns and the results of rows (key, t, text, ...), dealt to blocks."""
    rows = rows.select(F.pmod(F.xxhash64(F.lit("block"), "key", "t"), F.lit(blocks)).cast("int").alias("block"), F.col("key").alias("key"), "text",
                       *[F.col(c).alias(f"own_{c}") for c in kept])
    own = [f"own_{c}" for c in kept]
    grouped = rows.groupBy("block")
    maybe = grouped.applyInArrow(_sketch(segments, n), SKETCH) \
        .groupBy("segment").applyInArrow(merge_sketches, REPLY)
    firsts = grouped.cogroup(maybe.groupBy("block")).applyInArrow(_group_exactly(segments, n), "segment int, block int, n int, data binary") \
        .groupBy("segment").applyInArrow(_find_first, REPLY)
    schema = T.StructType([rows.schema[c] for c in own] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                          T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                          T.StructField("kept_text", T.StringType())])
    out = grouped.cogroup(maybe.unionByName(firsts).groupBy("block")).applyInArrow(_finish(segments, n, own, untouched), schema)
    return out.withColumnsRenamed(dict(zip(own, kept, strict=True)))
