"""Packing: exact round trip of ids and places; sharding: law, slots, sizes."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hopweave.llm import packing, sharding, textops
from hopweave.llm.queries import tokenizer_paths

from .cases import documents, frame

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def ids_of(texts):
    out = []
    for s in textops.slices(pa.array(texts, pa.string()), 200):
        ids, begin = packing.token_ids(s, *tokenizer_paths())
        out += [list(ids[begin[k]:begin[k + 1]]) for k in range(s.rows)]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab É.,!?'s\n\r\t  　\u0085日😀÷×|-1<>endofx"), max_size=40), max_size=12))
def test_ids_are_the_tokenizers(texts):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    assert ids_of(texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_ids_of_all_documents_are_the_tokenizers(spark, tokenizer):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert ids_of(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_round_trip(spark, tokenizer):
    rows = documents()
    cap = 64
    got = packing.pack(frame(spark), *tokenizer_paths(), capacity=cap, group_pieces=25).collect()
    want = Counter()
    for r in rows:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        cuts = [0, *range(len(ids) % cap or cap, len(ids) + 1, cap)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r[0], p, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for at, length in sorted(places):
            assert at == end
            end += length
        assert end <= cap
    total = sum(r["length"] for r in got)
    assert len(bins) <= 1.03 * -(-total // cap) + 1


def test_local_search_empties_bins():
    lengths = np.array([6, 6, 5, 5, 4, 4, 4, 3, 3])     # 40 in bins of 10
    bad = [[0], [1], [2, 3], [4, 5], [6, 7], [8]]
    better = packing.local_search(lengths, [list(b) for b in bad], 10)
    assert sorted(i for b in better for i in b) == list(range(9))
    assert all(lengths[b].sum() <= 10 for b in better) and len(better) < len(bad)


def test_pack_empty(spark):
    assert packing.pack(frame(spark, []), *tokenizer_paths()).count() == 0


def test_sharding_law_and_slots(spark):
    rows = documents()
    out = sharding.place(frame(spark), bucket_rows=7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert set(slots) <= set(range(8))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in out}) == len({r["doc_id"] for r in out})
    assert sharding.place(frame(spark, [])).count() == 0


def test_grown_shard_is_the_shard_of_nine(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    nine = df.select("doc_id", sharding.shard_of(F.col("doc_id"), sharding.balanced_tree(9)).alias("nine"))
    got = sharding.place(df).join(nine, "doc_id").groupBy("shard", "grown_shard", "nine").count().collect()
    assert all(r["grown_shard"] == r["nine"] and r["nine"] in (r["shard"], 8) for r in got)
    assert {r["nine"] for r in got} == set(range(9))


def test_weights_and_movement(spark):
    ids = spark.range(20_000)
    tree = sharding.Node("", (sharding.Node("a", (sharding.Node("x", shard=0, leaf_weight=3.0), sharding.Node("y", shard=1))),
                              sharding.Node("b", (sharding.Node("x", shard=2, leaf_weight=4.0),))))
    heavier = sharding.Node("", (sharding.Node("a", (sharding.Node("x", shard=0, leaf_weight=3.0), sharding.Node("y", shard=1, leaf_weight=2.0))), tree.children[1]))
    got = ids.select(sharding.shard_of(F.col("id"), tree).alias("s"), sharding.shard_of(F.col("id"), heavier).alias("t")).groupBy("s", "t").count().collect()
    share = Counter()
    for r in got:
        share[r["s"]] += r["count"] / 20_000
        assert r["s"] == r["t"] or r["t"] in (0, 1)     # rows only move into the subtree that grew
        assert not (r["s"] == 1 and r["t"] != 1)
    assert abs(share[0] - 3 / 8) < 0.02 and abs(share[1] - 1 / 8) < 0.02 and abs(share[2] - 1 / 2) < 0.02
