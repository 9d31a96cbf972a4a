"""Every training word of the language model has a class of its own."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hopweave.llm import class_lm, textops

from .cases import fold


def texts_of_two_languages():
    """1,200 frequent words in two halves that never meet, and rare words that share their last two bytes."""
    rnd = random.Random(3)
    rows = []
    for k in range(1200):
        side = "ab"[k % 2]
        w = [f"{side}{rnd.randrange(600)}{side}" for _ in range(40)]
        for x in range(6):
            w[rnd.randrange(40)] = f"{side}rare{rnd.randrange(300)}zz" if x else f"{side.upper()}Rare{k % 7}zz"
        rows.append((k, " ".join(w)))
    return rows


def hashes(words):
    col = pa.array(words)
    return {w: int(h) for s in textops.slices(col) for w, h in zip(words, textops.word_hashes(s, textops.words_of(s), fold=True).view(np.int64), strict=True)}


@pytest.mark.parametrize("head", [65_536, 1100])
def test_rare_words_are_scored_by_their_own_class(spark, head, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", head)
    rows = texts_of_two_languages()
    model, classes = class_lm.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    words = sorted({w.decode() for _, t in rows for w in fold(t)})
    by_hash = {h: w for w, h in hashes(words).items()}
    cls = {by_hash[int(h)]: int(c) for h, c in zip(model.head.word.view(np.int64), model.cls, strict=True)}
    assert len(cls) == min(head, len(words))
    cls |= {by_hash[r["word"]]: r["cls"] for r in classes.collect()}
    assert set(cls) == set(words)
    # rare words of the two halves share a suffix, but not a class
    a, b = (Counter(cls[w] for w in words if w.startswith(f"{s}rare")) for s in "ab")
    assert not set(a) & set(b)

    # class bigrams and scores, recounted from the classes
    end = int(model.group[class_lm._END])
    n, count = np.zeros((class_lm.CLASSES, class_lm.CLASSES)), Counter()
    for _, t in rows:
        path = [end, *(cls[w.decode()] for w in fold(t)), end]
        count.update([*(w.decode() for w in fold(t)), None])
        for x, y in zip(path, path[1:], strict=False):
            n[x, y] += 1
    share = (n.sum(0) + 0.5) / (n.sum() + 0.5 * class_lm.CLASSES)
    step = np.log10((n + class_lm.SMOOTH * share) / (n.sum(1, keepdims=True) + class_lm.SMOOTH))
    kinds = Counter([*cls.values(), end])
    room = [math.log10(n[:, c].sum() + 0.5 * (kinds[c] + 1)) for c in range(class_lm.CLASSES)]
    s = textops.slices
    new = ["unseenzz unseenzz a1a", "a2a newzz brare3zz", "", "arare1zz arare2zz newqq arare2zz", "a1a arare5zz a2a", "a1a brare5zz a2a"]
    suffix = {w: int(class_lm._suffix(x, textops.words_of(x))[0]) for w in ("unseenzz", "newzz", "newqq") for x in s(pa.array([w]))}
    of = lambda w: cls.get(w, int(model.group[class_lm.CLUSTERED + suffix.get(w, 0)]))

    def expected(text):
        path = [(end, None), *((of(w), w) for w in (x.decode() for x in fold(text))), (end, None)]
        return sum(step[x, y] + math.log10(count[w] + 0.5) - room[y] for (x, _), (y, w) in zip(path, path[1:], strict=False))

    all_rows = rows + [(5000 + k, t) for k, t in enumerate(new)] + [(6000, None)]
    got = {r["doc_id"]: r["score"] for r in class_lm.score(spark.createDataFrame(all_rows, "doc_id long, text string").repartition(3), model, classes).collect()}
    assert got == {k: pytest.approx(expected(t), abs=1e-6) for k, t in all_rows}
