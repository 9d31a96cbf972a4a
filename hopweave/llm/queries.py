"""Registered queries of the subpackage and their SQL, added by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopweave.llm import (class_lm, decontaminate, filter_audit, jaccard_join, language_id, minhash_dedup, nearest, packing,
                          prefix_trie, quality, quotation, sharding, substring_dedup)
from hopweave.llm.common import crc_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_paths() -> tuple[str, str]:
    """The byte-level tokenizer and its rank table, installed on every node (never copied)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op1_jaccard_join")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a 4-word shingle Jaccard similarity of 0.85 or more."""
    return jaccard_join.join_components(table(spark, sf_dir, "documents"), n=4, percent=85) \
        .select("doc_id", "n_shingles", "component_id")


@query("op2_pack")
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_paths())


@query("op3_hash_tree_shards")
def op3_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by the weighted hash tree (law: key)."""
    return sharding.place(table(spark, sf_dir, "documents"), sharding.balanced_tree(8)) \
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_bucket(F.col("doc_id"), 4) == 2)
    labels = table(spark, sf_dir, "labels").where(crc_bucket(F.col("doc_id"), 4) != 2)
    model = quality.fit(docs.where(~F.col("held_out")), labels)
    return quality.score(docs, model, keep=("doc_id", "held_out")) \
        .withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat in 20-word windows removed from every document but the earliest."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_class_lm")
def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based language model score of every document, learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_bucket(F.col("doc_id"), 5) == 1)
    model, counts = class_lm.fit(docs.where(~F.col("held_out")))
    return class_lm.score(docs, model, counts, keep=("doc_id", "held_out"))


@query("op7_decontaminate", decontaminate.ORACLE)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds 80 % or more."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_quotation", quotation.ORACLE)
def op8_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in reply order: quotes linked to their originals and removed."""
    return quotation.link_quotes(table(spark, sf_dir, "conversations"))


@query("op9_multi_index_nearest")
def op9_multi_index_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest rows (largest inner product) of every 20th embedding, against all rows."""
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_bucket(F.col("doc_id"), 5) == 0)
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, keep=("doc_id", "held_out")) \
        .withColumnRenamed("lang_score", "score").withColumnRenamed("lang_ambiguous", "ambiguous")


@query("op11_prefix_trie", prefix_trie.ORACLE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all prefixes of the rebuilt conversations, with the totals of every subtree."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_minhash_dedup")
def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of documents: 3-word shingle sets with a Jaccard similarity of 0.85 or more."""
    return minhash_dedup.near_copies(table(spark, sf_dir, "documents"), n=3, percent=85) \
        .select("doc_id", "n_shingles", "component_id", "kept")


@query("op13_filter_audit", filter_audit.ORACLE)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in all 120 orders, by language, with the labels it costs."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
