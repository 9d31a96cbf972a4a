"""Language identification by error-correcting output codes.

Every learned language gets a codeword of bits.  One binary n-gram classifier per bit
(log-odds of hashed byte n-grams between the languages whose bit is 1 and those whose
bit is 0) gives a margin; loss-weighted decoding picks the language whose codeword has
the smallest weighted logistic loss against all margins, and flags texts whose two best
codewords are nearly tied.

Training is one distributed count over all training rows: Spark sums hashed n-gram
counts per language (at most ``languages x 2^HASH_BITS`` numbers, whatever the corpus
size); the classifiers are closed-form in these counts.  Scoring reads each text once.

Defined results: null text, empty text or a text without any letter -> ``und``, score 0,
not ambiguous; no training rows -> every text ``und``; a single learned language -> that
language with score 1.  Ties between codewords go to the language that sorts first.
Rows repeat as they come in; only the named columns are read, and a kept column whose
name clashes with an output column is replaced by the output.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.llm.common import stage
from hopweave.llm.textops import give_back, mix64, slices, word_hashes, words_of

UND = "und"
HASH_BITS = 14
ORDERS = (1, 2, 3)
#: Bytes of text handled at once; the n-gram arrays of a slice are up to a hundred times that.
SLICE_BYTES = 512 << 10
#: More languages than this are refused: the count table must stay small.
MAX_LANGUAGES = 512
#: Up to this many languages the code is exhaustive (2^(L-1) - 1 bits).
EXHAUSTIVE = 5
#: Margins are mean log-odds per n-gram, times this, times the square root of the
#: number of n-grams up to LENGTH_CAP (a longer text says more).
SHARPNESS, LENGTH_CAP = 1.0, 400.0
#: A text is ambiguous when its two best languages' shares differ by less than this.
AMBIGUOUS_GAP = 0.2

_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 0x100)


@dataclass
class EcocModel:
    languages: list[str]
    code: np.ndarray      # (languages, bits) of +1 / -1
    weights: np.ndarray   # (2^HASH_BITS, bits) log-odds
    trust: np.ndarray     # (bits,) weights of the losses, sum 1


def _word_types(s):
    """(types, type of each word, first word of each row): distinct words of a slice."""
    w = words_of(s)
    h = word_hashes(s, w)
    _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    return w.start[at], w.end[at], inverse, w.first


def _type_ngrams(data, start, end):
    """(type, bucket) of the hashed byte n-grams of words, with a blank on both sides."""
    size = end - start + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    buf = np.full(int(begin[-1]), 0x20, dtype=np.uint8)
    owner = np.repeat(np.arange(len(size)), size)
    offset = np.arange(len(buf)) - begin[owner]
    inner = (offset > 0) & (offset < size[owner] - 1)
    buf[inner] = _LETTER[data[(start[owner] + offset - 1)[inner]]]
    types, buckets = [], []
    for n in ORDERS:
        if len(buf) < n:
            continue
        key = np.zeros(len(buf) - n + 1, dtype=np.uint64)
        for k in range(n):
            key = (key << np.uint64(8)) | buf[k:len(buf) - n + 1 + k].astype(np.uint64)
        ok = owner[:len(key)] == owner[n - 1:]
        if n == 1:
            ok &= buf != 0x20
        else:  # at least one letter
            ok &= key != int.from_bytes(b" " * n, "big")
        key, own = key[ok], owner[:len(ok)][ok]
        buckets.append((mix64(key + np.uint64(n << 56)) >> np.uint64(64 - HASH_BITS)).astype(np.int64))
        types.append(own)
    return np.concatenate(types), np.concatenate(buckets)


def ngram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n): hashed n-gram counts per language over all rows with a language."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches):
        names: dict[str, int] = {}
        total = np.zeros((0, 1 << HASH_BITS))
        for b in batches:
            langs = b.column("lang").to_pylist()
            for s in slices(b.column("text"), SLICE_BYTES):
                start, end, inverse, first = _word_types(s)
                if not len(start):
                    continue
                own = np.array([names.setdefault(x, len(names)) for x in langs[s.lo:s.hi]], dtype=np.int64)
                if len(names) > len(total):
                    total = np.vstack([total, np.zeros((len(names) - len(total), 1 << HASH_BITS))])
                lang_of_word = np.repeat(own, np.diff(first))
                types, buckets = _type_ngrams(s.data, start, end)
                for k in np.unique(own):
                    tf = np.bincount(inverse[lang_of_word == k], minlength=len(start))
                    total[k] += np.bincount(buckets, weights=tf[types], minlength=1 << HASH_BITS)
            give_back()
        for name, k in names.items():
            at = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()),
                                              "n": pa.array(total[k][at], pa.float64())})

    return rows.mapInArrow(count, "lang string, bucket int, n double") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) of +-1: the exhaustive code for few languages, else the random code
    (balanced columns, no two alike or opposite) with the largest least distance of 200 drawn."""
    if n <= 1:
        return np.ones((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE:
        cols = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(cols, dtype=np.int8).T
    bits, rng, best, far = max(15, 5 * int(np.ceil(np.log2(n)))), np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = np.stack([rng.permutation(np.where(np.arange(n) % 2, 1, -1)) for _ in range(bits)], 1)
        code = code * code[:1]
        gaps = (code[:, None, :] != code[None]).sum(2)[~np.eye(n, dtype=bool)]
        score = gaps.min() - (bits - len({tuple(c) for c in code.T}))
        if score > far:
            best, far = code.astype(np.int8), score
    return best


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> EcocModel:
    """Learn from every row of ``docs`` that has a language and a text."""
    counts = stage(ngram_counts(docs, text_col, lang_col), "language-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((len(langs), 1 << HASH_BITS))
    if langs:
        pdf = counts.toPandas()
        place = {x: k for k, x in enumerate(langs)}
        table[pdf["lang"].map(place).to_numpy(), pdf["bucket"].to_numpy()] = pdf["n"].to_numpy()
    return _closed_form(langs, table)


def _closed_form(langs: list[str], table: np.ndarray) -> EcocModel:
    code = codewords(len(langs))
    share = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * table.shape[1])
    cols, trust = [], []
    for bit in code.T:
        one, zero = share[bit > 0].mean(0), share[bit < 0].mean(0)
        odds = np.log(one / zero)
        cols.append(odds)
        trust.append(float(((one - zero) * odds).sum()))  # how far the two sides are apart
    weights = np.stack(cols, 1).astype(np.float32) if cols else np.zeros((table.shape[1], 0), np.float32)
    trust = np.array(trust) / max(sum(trust), 1e-12)
    return EcocModel(langs, code, weights, trust)


def decode(model: EcocModel, margins: np.ndarray, sizes: np.ndarray):
    """(best language index, its share, gap to the second) of each row of summed margins."""
    scale = SHARPNESS * np.sqrt(np.minimum(sizes, LENGTH_CAP)) / np.maximum(sizes, 1)
    z = margins * scale[:, None]
    loss = np.stack([(np.logaddexp(0, -z * c[None]) * model.trust * len(model.trust)).sum(1) for c in model.code], 1)
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    best = share.argmax(1)
    top = share[np.arange(len(best)), best]
    rest = share.copy()
    rest[np.arange(len(best)), best] = 0
    return best, top, top - (rest.max(1) if rest.shape[1] > 1 else 0)


def identify(docs: DataFrame, model: EcocModel, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus lang_pred, lang_score and lang_ambiguous for every row."""
    out = ["lang_pred", "lang_score", "lang_ambiguous"]
    keep = [c for c in keep if c not in out]
    texts = F.col(text_col).alias("__text") if text_col not in keep else F.lit(None).cast("string").alias("__text")
    source = "__text" if text_col not in keep else text_col
    rows = docs.select(*keep, texts, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()),
                          T.StructField("lang_score", T.DoubleType()), T.StructField("lang_ambiguous", T.BooleanType())])
    langs, bits = np.array(model.languages, dtype=object), model.code.shape[1]

    def score(batches):
        for b in batches:
            letters = b.column("__letters").to_numpy(zero_copy_only=False)
            pred, share, unsure = [], [], []
            for s in slices(b.column(source), SLICE_BYTES):
                ok = letters[s.lo:s.hi]
                sums, sizes = np.zeros((s.rows, bits)), np.zeros(s.rows)
                start, end, inverse, first = _word_types(s)
                if len(start):
                    types, buckets = _type_ngrams(s.data, start, end)
                    per_type = np.stack([np.bincount(types, weights=model.weights[buckets, k], minlength=len(start))
                                         for k in range(bits)], 1) if bits else np.zeros((len(start), 0))
                    n_type = np.bincount(types, minlength=len(start))
                    cum = np.zeros((len(inverse) + 1, bits))
                    np.cumsum(per_type[inverse], axis=0, out=cum[1:])
                    sums = cum[first[1:]] - cum[first[:-1]]
                    cn = np.concatenate([[0], np.cumsum(n_type[inverse])])
                    sizes = (cn[first[1:]] - cn[first[:-1]]).astype(float)
                if len(langs):
                    best, top, gap = decode(model, sums, sizes)
                    pred.append(np.where(ok, langs[best], UND))
                    share.append(np.where(ok, top, 0.0))
                    unsure.append(ok & (gap < AMBIGUOUS_GAP) if len(langs) > 1 else np.zeros(s.rows, bool))
                else:
                    pred.append(np.full(s.rows, UND, dtype=object))
                    share.append(np.zeros(s.rows))
                    unsure.append(np.zeros(s.rows, bool))
            cat = lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [cat(pred, pa.string()), cat(share, pa.float64()), cat(unsure, pa.bool_())],
                                             names=[*keep, *out])
            give_back()

    return rows.mapInArrow(score, schema)
