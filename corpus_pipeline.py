"""Corpus pipeline over ``documents``: each stage applies one operator of ``hopweave.llm``.

Every stage takes (spark, docs, sf_dir) with all rows its predecessor kept and returns
what it keeps, with the columns of documents; the last returns the packed pieces.  Null and
empty texts, repeated rows, null ids and empty tables have the results that the operators
define: a text without letters goes in the first stage, repeated rows in the second; extra
columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopweave.llm import decontaminate, jaccard_join, language_id, packing, substring_dedup
from hopweave.llm.common import crc_bucket, stage, table
from hopweave.llm.queries import tokenizer_paths

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows without a language (no text, no letter) or torn between two go."""
    model = language_id.fit(docs.where(crc_bucket(F.col("doc_id"), 5) != 0))
    found = language_id.identify(docs, model, keep=COLUMNS)
    return found.where((F.col("lang_pred") != language_id.UND) & ~F.col("lang_ambiguous")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (five words, 0.8): the smallest id of every component stays."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS), n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages of 20 words that start earlier elsewhere are cut out; a text
    of which nothing is left goes, a text that loses nothing stays as it is."""
    cut = substring_dedup.remove_repeats(docs, keep=("doc_id", "lang", "source", "n_chars"), untouched=True)
    touched = F.col("n_removed") > 0
    return cut.where(~touched | (F.col("n_removed") < F.col("n_words"))).select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.when(touched, F.length("kept_text").cast("long")).otherwise(F.col("n_chars").cast("long")).alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold 80 % of a benchmark item go."""
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: what is left, in sequences of at most 2048 tokens."""
    return packing.pack(docs, *tokenizer_paths())


STAGES = [
    ("language_id", keep_identified),
    ("jaccard_join", keep_one_of_each),
    ("substring_dedup", cut_repeats),
    ("decontaminate", drop_leaks),
    ("pack", pack_sequences),
]

# Classifier decisions, a set-similarity join and a local search are not SQL: the
# pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
