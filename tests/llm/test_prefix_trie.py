"""Prefix trie against its SQL over awkward conversations."""

import hashlib
import random

from hopweave.llm import prefix_trie

from .sqlcheck import same

SCHEMA = "conv_id long, turn long, role string, text string, depth int, c string"


def conversations(seed=1):
    rnd = random.Random(seed)
    says = ["hello there", "a  b\tc", "", None, "what is it", "yes no yes"]
    rows = []
    for c in [*range(0, 65), -3, -20, -25, 1000, 2**53 + 1]:
        for t in range(rnd.choice([0, 1, 2, 3, 4, 5, 9])):
            rows.append((c, rnd.choice([t, t, t, None, 0]), rnd.choice(["user", "user", None]), rnd.choice(says[:rnd.choice([1, 2, 6])]), 7, "x"))
    for c in (120, 121, 122, 140, 141, 160, 161):      # long ones, alike for a while
        rows += [(c, t, "user", f"turn {t if t < 37 else c}", 7, "x") for t in range(70 if c % 2 else 37)]
    return rows + [(5, 1, "user", "tie", 7, "x")] * 3 + [(None, 1, "user", "nobody", 7, "x"), (400, 0, "user", "only base words", 7, "x")]


def test_trie_is_its_sql(spark):
    df = spark.createDataFrame(conversations(), SCHEMA).repartition(5)
    want = same(prefix_trie.trie(df), prefix_trie.ORACLE, conversations=df)
    assert max(r[1] for r in want) > 64 and any(r[6] for r in want)


def test_a_hot_conversation_and_equal_conversations(spark):
    rows = [(40, t, "user", f"w{t % 3}", 1, "") for t in range(150)]
    rows += [(100 + 20 * k, t, "user", "same words", 1, "") for k in range(60) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    same(prefix_trie.trie(df), prefix_trie.ORACLE, conversations=df)


def test_turnless_and_empty(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    short = [(c, 0, "u", "t", 1, "") for c in (1, 2, 3, 4, 5, 6)]      # no base conversation: some lose their only turn
    df = spark.createDataFrame(short, SCHEMA)
    same(prefix_trie.trie(df), prefix_trie.ORACLE, conversations=df)


def test_digest_of_many_pieces(spark):
    old, prefix_trie.PIECE_BYTES = prefix_trie.PIECE_BYTES, 100
    try:
        ends = spark.range(0, 5000).selectExpr("id % 2 as x", "0L as y", "id as c")
        got = {r["x"]: r["ends"] for r in prefix_trie.ends_digest(ends).collect()}
    finally:
        prefix_trie.PIECE_BYTES = old
    for x in (0, 1):
        assert got[x] == hashlib.sha256(",".join(str(c) for c in range(x, 5000, 2)).encode()).hexdigest()
