"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred, turned by two learned rotations (iterative quantisation: the
rotation that brings the vectors closest to their own sign patterns) and cut to signs.
Largest inner product becomes smallest angle by one more component that fills every
vector up to the largest length; queries have 0 there.

Index: a code is split into bytes, and each byte position has a table from byte to rows.
By the pigeonhole principle a code within Hamming radius ``r`` of the query agrees with
it in some byte up to ``r // bytes`` flipped bits (one less for the later positions), so
probing those buckets finds every code within ``r``.  Those codes are ranked by the exact
inner product of the original vectors.

Scale: all rows are indexed, in blocks of bounded size; the stated queries meet every block
in chunks of bounded size (one task each), and the best ``k`` of each block are merged per
query.  Rotations and radius are fitted on ``SAMPLE_ROWS`` rows (those with the smallest
hashed ids): the radius holds ``COVER`` of the sample's own true neighbours, which lie
farther out than those in the full table, so it errs to the safe side.  A block where fewer
than ``k`` codes lie within the radius is searched with a larger one.  Up to 50 ``k`` sample
rows are too few to learn a radius from: such small tables are searched exhaustively, so
recall there says nothing about the index.

Defined results: vectors that are null, zero, of another than the most frequent length, or
that hold null or non-finite components take no part, nor do null ids; a repeated id takes
part once, with the smallest of its vectors; ties go to the smaller id; with fewer than
``k`` other rows all are returned; an empty table gives no rows.  Only the id and vector
columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopweave.llm.common import pieces_for, stage

SAMPLE_ROWS = 4096
ROTATIONS, ITERATIONS = 2, 30
CODE_DIMS = 64
COVER = 0.985
BLOCK_ROWS, QUERY_ROWS = 8192, 2048

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_APART = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


@dataclass
class Codes:
    centre: np.ndarray
    turn: np.ndarray      # (dims + 1, bits), bits a multiple of 8
    longest: float
    radius: int

    def encode(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """(rows, bytes) codes of original vectors."""
        fill = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest ** 2 - (x ** 2).sum(1), 0))
        return np.packbits((np.column_stack([x, fill]) - self.centre) @ self.turn > 0, axis=1)


def fit(sample: np.ndarray, longest: float, k: int = 20, seed: int = 5) -> Codes:
    """Rotations and radius from a sample of original vectors."""
    if not len(sample):
        return Codes(np.zeros(1), np.zeros((1, 8)), 0.0, 8)
    full = np.column_stack([sample, np.sqrt(np.maximum(longest ** 2 - (sample ** 2).sum(1), 0))])
    centre = full.mean(0)
    rng = np.random.default_rng(seed)
    dims = min(CODE_DIMS, full.shape[1])
    _, _, axes = np.linalg.svd(full - centre, full_matrices=False)
    axes = axes[:dims].T
    if axes.shape[1] < dims:                     # fewer rows than dimensions
        axes = np.linalg.qr(np.column_stack([axes, rng.normal(size=(full.shape[1], dims - axes.shape[1]))]))[0]
    flat = (full - centre) @ axes
    turns = []
    for _ in range(ROTATIONS):
        r = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        for _ in range(ITERATIONS):              # signs, then the rotation closest to them
            u, _, v = np.linalg.svd(flat.T @ np.where(flat @ r > 0, 1.0, -1.0))
            r = u @ v
        turns.append(axes @ r)
    turn = np.column_stack(turns)
    turn = np.column_stack([turn, np.zeros((turn.shape[0], -turn.shape[1] % 8))])
    codes = Codes(centre, turn, longest, turn.shape[1])
    queries = sample[:512]
    score = queries @ sample.T
    score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    near = np.argsort(-score, axis=1)[:, :max(1, min(k, len(sample) - 1))]
    all_codes, own = codes.encode(sample), codes.encode(queries, query=True)
    gap = _ONES[all_codes[near] ^ own[:, None, :]].sum(2)
    codes.radius = int(np.quantile(gap, COVER, method="higher")) if len(sample) > 50 * k else turn.shape[1]
    return codes


class MultiIndex:
    """Byte-wise tables over the codes of a block."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            cut = np.searchsorted(codes[order, j], np.arange(257))
            self.tables.append([order[cut[v]:cut[v + 1]] for v in range(256)])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius, found by probing the tables."""
        parts, extra = divmod(max(radius, 0), len(self.tables))
        found = np.zeros(len(self.codes), dtype=bool)
        for j, table in enumerate(self.tables):
            reach = parts if j <= extra else parts - 1
            if reach >= 0:
                for v in np.flatnonzero(_APART[code[j]] <= reach):
                    found[table[v]] = True
        rows = np.flatnonzero(found)
        return rows[_ONES[self.codes[rows] ^ code].sum(1) <= radius]


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids, in order."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search(codes: Codes, k: int):
    def search(queries, rows):
        found = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and rows.num_rows:
            x, q = _matrix(rows.column("v")), _matrix(queries.column("v"))
            ids, query_ids = rows.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()
            index, probes, bits = MultiIndex(codes.encode(x)), codes.encode(q, query=True), codes.turn.shape[1]
            for i in range(len(q)):
                radius = codes.radius
                near = index.within(probes[i], radius)
                while len(near) < min(k + 1, len(x)) and radius < bits:
                    radius = min(bits, radius + max(1, bits // 16))
                    near = index.within(probes[i], radius)
                near = near[ids[near] != query_ids[i]]
                score = (x[near] * q[i]).sum(1)
                top = best(score, ids[near], k)
                found["query_id"].append(np.full(len(top), query_ids[i]))
                found["vec_id"].append(ids[near][top])
                found["score"].append(score[top])
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.float64() if c == "score" else pa.int64()) for c, v in found.items()})
    return search


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): one usable double vector per id."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(fine)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
           block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product found for
    every row for which ``is_query`` (a condition on ``vec_id``) holds, its own id left out."""
    rows = stage(valid_vectors(vectors, id_col, vector_col), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"),
                    F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).first()
    sample = rows.orderBy(F.xxhash64(F.lit("sample"), "vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()["v"]
    codes = fit(np.array(sample.tolist(), dtype=np.float64), float(np.sqrt(size["longest"] or 0.0)), k)
    blocks, chunks = pieces_for(size["n"], block_rows), pieces_for(size["q"], query_rows)
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    index = rows.select("vec_id", "v", deal(blocks, "block").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    queries = rows.where(is_query).select("vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), deal(chunks, "chunk").alias("chunk"))
    found = queries.groupBy("block", "chunk").cogroup(index.groupBy("block", "chunk")) \
        .applyInArrow(_search(codes, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
