"""Filter audit against its SQL over awkward tables; the matrix and its dictionary by hand."""

import random

import pytest

from hopweave.llm import filter_audit

from .cases import documents, frame
from .sqlcheck import same

LABELS = "doc_id long, quality int, toxic int, lang string"


def labels(spark, ids, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 0, 1]), "x") for i in ids for _ in range(rnd.choice([0, 1, 1, 2]))]
    return spark.createDataFrame(rows, LABELS)


def more_cases():
    long = " ".join(f"w{k}" for k in range(230))
    texts = [long, long, long.upper(), long + " #", long + " w1" * 400, "A", "É" * 50, "$", None, None, "", long]
    rows = [(500 + k, t, "en" if k % 2 else None) for k, t in enumerate(texts)]
    rows += [(500, long, "fr"), (None, long, "en"), (None, long, "en"), (-7, long, ""), (501, "other text", "en")]
    return [(i, t, lang, "src", None, 0.5, 1, "x") for i, t, lang in rows]


@pytest.mark.parametrize("shard_bytes", [2000, 1 << 24])
def test_audit_is_its_sql(spark, shard_bytes):
    docs = frame(spark, documents() + more_cases())
    marks = labels(spark, [*range(60), 100, 105, 106, None, *range(500, 512), -7])
    want = same(filter_audit.audit(docs, marks, shard_bytes=shard_bytes), filter_audit.ORACLE, documents=docs, labels=marks)
    assert len(want) % 600 == 0 and any(r[7] for r in want) and any(r[9] for r in want)


def test_a_third_of_all_rows_equal(spark):
    rows = [(k, "same text here" if k % 3 == 0 else f"text {k}", "en", "s", 1, 0.0, 0, "") for k in range(300)]
    docs, marks = frame(spark, rows), labels(spark, range(300))
    same(filter_audit.audit(docs, marks), filter_audit.ORACLE, documents=docs, labels=marks)


def test_empty_tables(spark):
    docs, marks = frame(spark, []), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, marks).count() == 0
    full = frame(spark)
    same(filter_audit.audit(full, marks), filter_audit.ORACLE, documents=full, labels=marks)


def test_matrix_spells_the_texts(spark):
    docs = frame(spark)
    shards = filter_audit.csr_shards(docs, shard_bytes=3000)
    matrix, words = filter_audit.document_term_matrix(shards), filter_audit.dictionary(shards).collect()
    word = {r["id"]: r["word"] for r in words}
    assert len(set(word.values())) == len(word) == len(words)
    got = []
    for r in matrix.collect():
        for k, d in enumerate(r["docs"]):
            lo, hi = r["first"][k], r["first"][k + 1]
            assert r["columns"][lo:hi] == sorted(set(r["columns"][lo:hi]))
            got.append((d["doc_id"], sorted((word[c], n) for c, n in zip(r["columns"][lo:hi], r["counts"][lo:hi], strict=True))))
    want = []
    for i, t, *_ in documents():
        w = [x.decode() for x in (t or "").encode().split()]
        want.append((i, sorted((x, w.count(x)) for x in set(w))))
    assert sorted(got, key=repr) == sorted(want, key=repr)
