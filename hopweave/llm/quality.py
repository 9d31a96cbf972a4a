"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Features of a text are the hashed word uni- and bigrams (A-Z read as a-z) and the hashed
uni-, bi- and trigrams of word shapes (length class, letter case, last character, digits,
repeats the previous word).  A feature's value is its count divided by the square root of
its group's total, so the scale does not run away with the length.  A score is the
logistic of one sparse dot product.

Training uses a bounded sample: of all labelled rows those whose hashed id falls below
``max_rows / labelled rows`` (``max_rows`` is the parameter, 20,000 by default).  The sample
is dealt to a fixed number of shards; each round, every shard runs FTRL-proximal over its
rows from the common state, and the changes of the state are averaged by Spark.  The model
has ``2^BITS`` weights whatever the corpus size.

Defined results: null and empty texts have only the intercept; labels other than 0 and 1,
null labels and labels without a document are left out; repeated labelled rows all count;
no usable labels -> every score 0.5.  Only the named columns are read; a kept column whose
name is ``score`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.llm.common import stage
from hopweave.llm.textops import mix64, ngram_hashes, slices, word_hashes, words_of

BITS = 18
MAX_TRAIN_ROWS = 20_000
SHARDS, ROUNDS = 8, 3
#: FTRL-proximal: learning rate, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1

_GROUPS = ((0, 1), (0, 2), (1, 1), (1, 2), (1, 3))  # (0 word / 1 shape, n)
_INTERCEPT = 0


@dataclass
class QualityModel:
    weights: np.ndarray


def _shapes(s, w, h):
    """A small code per word: length class, case, last byte, digit, repeat."""
    d = s.data
    at = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    upper, lower = at((d >= 65) & (d <= 90)), at(((d >= 97) & (d <= 122)) | (d >= 0x80))
    digit = at((d >= 48) & (d <= 57))
    has = lambda c: c[w.end] > c[w.start]
    first, last = d[w.start], d[w.end - 1]
    case = np.where(has(lower), np.where((first >= 65) & (first <= 90), 1, 0), np.where(has(upper), 2, 3))
    tail = np.where((last >= 97) & (last <= 122) | (last >= 65) & (last <= 90) | (last >= 0x80), 0, last.astype(np.int64))
    size = np.searchsorted([1, 2, 4, 7, 11, 16, 31], w.end - w.start, side="right")
    again = np.zeros(len(h), dtype=np.int64)
    again[1:] = h[1:] == h[:-1]
    starts = w.first[:-1][np.diff(w.first) > 0]
    again[starts] = 0
    return (((case * 256 + tail) * 8 + size) * 2 + has(digit)) * 2 + again


def features(s):
    """(row, feature, value) of a slice, the intercept included, sorted by row."""
    w = words_of(s)
    h = word_hashes(s, w, fold=True)
    shape = mix64(_shapes(s, w, h).astype(np.uint64), 0x51) if len(h) else h
    rows, feats, vals = [np.arange(s.rows)], [np.full(s.rows, _INTERCEPT)], [np.ones(s.rows)]
    for k, (kind, n) in enumerate(_GROUPS):
        g, begin = ngram_hashes(shape if kind else h, w.first, n, seed=0x1000 + k)
        if not len(g):
            continue
        row = np.repeat(np.arange(s.rows), np.diff(begin))
        key, tf = np.unique((row.astype(np.int64) << BITS) | (g >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
        r = key >> BITS
        rows.append(r)
        feats.append(np.maximum(key & ((1 << BITS) - 1), 1))
        vals.append(tf / np.sqrt(np.bincount(r, weights=tf.astype(float) ** 2, minlength=s.rows)[r]))
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return row[order], np.concatenate(feats)[order], np.concatenate(vals)[order]


def _weights(z, n):
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def _train_shard(table: pa.Table, z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over a shard's rows, in the order of their hashed ids."""
    z, n = z.copy(), n.copy()
    table = table.sort_by([("__order", "ascending"), ("__y", "ascending")])
    label = table.column("__y").to_numpy()
    for s in slices(table.column("__text")):
        row, feat, val = features(s)
        cut = np.searchsorted(row, np.arange(s.rows + 1))
        for r in range(s.rows):
            i, x = feat[cut[r]:cut[r + 1]], val[cut[r]:cut[r + 1]]
            w = _weights(z[i], n[i])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label[s.lo + r]) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            # hashed features of different groups may meet in one index
            np.add.at(z, i, g - sigma * w)
            np.add.at(n, i, g * g)
    return z, n


def _step(z, n):
    """Changes of the state after one pass over a shard."""
    def step(rows):
        z1, n1 = _train_shard(rows, z, n)
        at = np.flatnonzero((z1 != z) | (n1 != n))
        return pa.table({"i": pa.array(at, pa.int32()), "dz": (z1 - z)[at], "dn": (n1 - n)[at]})
    return step


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_TRAIN_ROWS, rounds: int = ROUNDS, shards: int = SHARDS) -> QualityModel:
    """Learn from (a bounded sample of) the labelled rows of ``docs``."""
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y")) \
        .where(F.col("__id").isNotNull() & F.col("__y").isin(0.0, 1.0)) \
        .withColumn("__order", F.xxhash64(F.lit("quality"), F.col("__id")))
    total = marked.count()
    keep = min(1.0, max_rows / max(total, 1))
    if keep < 1:
        marked = marked.where(F.shiftrightunsigned("__order", 11) < F.lit(int(keep * (1 << 53))))
    # The sample is bounded by max_rows, so it may be broadcast.
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(marked), "__id") \
        .withColumn("__shard", F.pmod(F.shiftright("__order", 7), F.lit(shards)).cast("int")) \
        .select("__shard", "__order", "__y", "__text")
    sample = stage(sample.repartition(shards, "__shard"), "quality-sample")
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(rounds):
        change = sample.groupBy("__shard").applyInArrow(_step(z, n), "i int, dz double, dn double") \
            .groupBy("i").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn")).toPandas()  # at most 2^BITS rows
        z, n = z.copy(), n.copy()
        z[change["i"]] += change["dz"] / shards
        n[change["i"]] += change["dn"] / shards
    return QualityModel(_weights(z, n).astype(np.float32))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``score``: the probability of label 1, for every row."""
    keep = [c for c in keep if c != "score"]
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    weights = model.weights

    def apply(batches):
        for b in batches:
            out = [np.zeros(0)]
            for s in slices(b.column("__text")):
                row, feat, val = features(s)
                margin = np.bincount(row, weights=weights[feat] * val, minlength=s.rows)
                out.append(1 / (1 + np.exp(-np.clip(margin, -35, 35))))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(out), pa.float64())], names=[*keep, "score"])

    return rows.mapInArrow(apply, schema)
