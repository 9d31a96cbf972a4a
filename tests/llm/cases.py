"""Small awkward tables shared by the tests: nulls, empty and very long texts, ties, repeats,
clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, removed string"


def documents(seed=1, n=60):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéüñ") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    text = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    rows = []
    base = [text(rnd.choice([30, 60, 120])) for _ in range(8)]
    for i in range(n):
        t = text(rnd.randint(1, 150))
        if i % 3 == 0:
            w = rnd.choice(base).split()
            for _ in range(rnd.choice([0, 1, 2, 4, 8])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            t = " ".join(w[rnd.choice([0, 0, 5]):])
        if i % 10 == 4:
            t = t + "\n" + base[0]
        rows.append((i, t, rnd.choice(["en", "de", None])))
    rows += [(100, None, "en"), (101, "", "en"), (102, " \t\n ", None), (103, "one", "de"), (104, "12 34 !!", "en"),
             (105, rows[0][1].upper(), "en"), (106, rows[0][1], "en"), (106, rows[0][1], "en"), (None, rows[3][1], "en"),
             (None, "null id only here", "de"), (107, "ab " * 30, "en"), (108, text(9000), "en"), (109, "x  y  z w  'é's", None),
             (110, "a,b.c;d\n\ne f\r\ng \U0001f600!", "de")]
    return [(i, t, lang, "src", len(t) if t else None, 0.5, 1, "x") for i, t, lang in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def fold(text):
    return (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
