"""Substring dedup deals rows that share an id, or have none, to many blocks."""

import hashlib
import random
from collections import Counter

from hopweave.llm import substring_dedup

from .test_sets_and_windows import brute_removed


def rows_of_few_ids():
    rnd = random.Random(8)
    vocab = [f"v{k}" for k in range(300)]
    shared = [" ".join(rnd.choice(vocab) for _ in range(12)) for _ in range(10)]
    text = lambda k: " ".join([*(rnd.choice(vocab) for _ in range(k)), rnd.choice(shared), *(rnd.choice(vocab) for _ in range(30)), rnd.choice(shared)])
    copy = text(9)
    return [(None, text(k % 9)) for k in range(110)] + [(7, text(k % 5)) for k in range(110)] + [(5, copy)] * 110 + [(k, text(4)) for k in range(100, 190)] \
        + [(3, None), (3, ""), (None, None), (6, copy), (5, None)] + [(4, None)] * 70 + [(4, "")] * 70


def test_no_block_holds_all_rows_of_one_id(spark, monkeypatch):
    rows, real = rows_of_few_ids(), substring_dedup._finish

    def watched(*args):
        finish = real(*args)

        def within(docs, replies):
            assert sum(len(x.as_py() or "") for x in docs.column("text")) <= 12_000
            return finish(docs, replies)
        return within

    monkeypatch.setattr(substring_dedup, "_finish", watched)
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, place int").repartition(5)
    out = substring_dedup.remove_repeats(docs, n=6, keep=("doc_id", "place"), block_bytes=6000, segment_windows=900, untouched=True)
    assert out.columns == ["doc_id", "place", "n_words", "n_removed", "removed", "kept_text"]
    got = out.collect()
    assert sorted(r["place"] for r in got) == list(range(len(rows)))
    assert all(r["doc_id"] == rows[r["place"]][0] for r in got)
    assert all(r["kept_text"] == rows[r["place"]][1] for r in got if not r["n_removed"])
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(b" ".join((r["kept_text"] or "").encode().split())).hexdigest()) for r in got) \
        == brute_removed(rows, 6)
