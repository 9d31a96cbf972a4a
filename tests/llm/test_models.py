"""Language ID, quality and language model: held-out accuracy, exact base scores, edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopweave.llm import class_lm, language_id, quality
from hopweave.llm.common import crc_bucket
from hopweave.llm.queries import QUERIES

from .cases import documents, fold, frame

SF = "/root/testdata/sf0.001"


def test_language_held_out(spark):
    got = QUERIES["op10_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    docs = frame(spark)
    model = language_id.fit(docs)
    rows = language_id.identify(docs, model, keep=("doc_id", "text", "score", "lang_score") if "lang_score" in docs.columns else ("doc_id", "text", "score")).collect()
    assert len(rows) == len(documents())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in ("en", "de", "und")
    nothing = language_id.fit(docs.where("doc_id < 0"))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    single = language_id.fit(docs.where("lang = 'en'"))
    assert {(r["lang_pred"], r["lang_score"]) for r in language_id.identify(docs.where("doc_id < 20"), single).collect()} == {("en", 1.0)}
    assert language_id.identify(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 9, 20])
def test_codewords_are_apart(n):
    code = language_id.codewords(n)
    gaps = (code[:, None] != code[None]).sum(2)[~np.eye(n, dtype=bool)]
    assert gaps.min() >= (1 if n == 2 else 2) and set(np.unique(code)) == {-1, 1}
    if n > 3:
        flipped = code.copy()
        flipped[:, 0] *= -1                        # one wrong bit still decodes
        if gaps.min() >= 3:
            assert all(((code != f).sum(1)).argmin() == k for k, f in enumerate(flipped))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    pos, neg = ([r["score"] for r in got if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in pos for b in neg]) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.9


def test_quality_edges(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (41, None), (42, 7), (9999, 1), (3, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, rounds=1, shards=2)
    rows = quality.score(docs, model, keep=("doc_id", "score", "text")).collect()
    assert len(rows) == len(documents()) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not (r["text"] or "").split()}
    assert len(empty) == 1                          # the intercept alone
    untrained = quality.fit(docs, labels.where("doc_id < 0"))
    assert {r["score"] for r in quality.score(docs, untrained).collect()} == {0.5}
    assert quality.score(frame(spark, []), model).count() == 0


def base_scores(rows, held):
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*fold(t), 0])
    n, v = sum(c.values()), len(c)
    score = lambda t: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*fold(t), 0])
    return [(i, len(fold(t)) + 1, sum(w in c for w in [*fold(t), 0]), n, round(score(t), 6)) for i, t in rows]


@pytest.mark.parametrize("head", [65_536, 1100])
def test_language_model_base(spark, head, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", head)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(-1, None), (-2, ""), (None, "the only word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", crc_bucket(F.col("doc_id"), 5) == 1)
    model, counts = class_lm.fit(docs.where("not held_out"))
    got = class_lm.score(docs, model, counts).collect()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == Counter(base_scores(rows, held))
    total = [sum(r[c] for r in got if r["doc_id"] is not None and held(r["doc_id"])) for c in ("score", "base_score")]
    assert total[0] > total[1]                      # better than the base model on held-out texts


def test_language_model_adds_up(spark):
    rows = [(k, t) for k, t in enumerate(["a b a c", "b a d", "a b c a b", "e f"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts = class_lm.fit(docs)
    words = ["a", "b", "c", "d", "e", "f"]
    texts = spark.createDataFrame([(k, w) for k, w in enumerate([*words, ""])], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in class_lm.score(texts, model, counts).collect()}
    end = {k: model.step[model.group[t], model.group[class_lm._END]] + model.type_log[class_lm._END]
           for k, t in enumerate(int(x) for x in model.head.rank[[int(np.flatnonzero(model.head.word == h)[0]) for h in _hashes(words)]])}
    mass = sum(10 ** (score[k] - end[k]) for k in range(len(words))) + 10 ** score[len(words)]
    assert 0.3 < mass <= 1 + 1e-9                   # the rest is kept for unseen words


def _hashes(words):
    import pyarrow as pa

    from hopweave.llm import textops
    out = []
    for s in textops.slices(pa.array(words)):
        out += list(textops.word_hashes(s, textops.words_of(s), fold=True))
    return out


def test_exchange_finds_planted_classes():
    rnd = np.random.default_rng(1)
    group = np.arange(40) % 4
    bigrams = np.zeros((40, 40))
    for _ in range(20_000):                         # class k is followed by class k + 1
        a = rnd.integers(40)
        b = rnd.choice(np.flatnonzero(group == (group[a] + 1) % 4))
        bigrams[a, b] += 1
    found = class_lm.exchange(bigrams, classes=4, rounds=20)
    assert len({(a, b) for a, b in zip(group, found, strict=True)}) == 4


def test_language_model_edges(spark):
    docs = frame(spark)
    model, counts = class_lm.fit(docs.where("doc_id < 0"))
    rows = class_lm.score(docs, model, counts, keep=("doc_id", "score", "source")).collect()
    assert len(rows) == len(documents()) and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows)
    assert all(abs(r["base_score"]) < 1e-6 and abs(r["score"]) < 1e-6 for r in rows)
    model, counts = class_lm.fit(docs)
    assert class_lm.score(frame(spark, []), model, counts).count() == 0


def test_language_slices_bound_the_work_arrays():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from hopweave.llm import language_id as li
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(60_000)]
    column = pa.array([" ".join(rng.choice(words, 2000)) for _ in range(300)])
    li.word_hashes(s := next(li.slices(column, li.SLICE_BYTES)), li.words_of(s))     # powers are kept
    tracemalloc.start()
    for s in li.slices(column, li.SLICE_BYTES):
        li._type_ngrams(s.data, *li._word_types(s)[:2])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
