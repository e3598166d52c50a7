"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and decides on all rows that its predecessor kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language_crf, simhash, suffix_dedup
from tidemark.llm.common import fresh_path, store, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_LANGUAGE = 0.4          # share of the words that a text's language has to hold
SHINGLE, BITS = 3, 3        # SimHash: words per shingle, differing bits at most
REPEAT = 200                # bytes of a string that may not start twice,
REPEAT_WORDS = 50           # where a run of such strings has this many words
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# The language field learns from the labels, the decision is made from the text; no SQL can say that.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are in one known language; such without a letter go."""
    return language_crf.confident(docs.select(*COLUMNS), MIN_LANGUAGE)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest doc_id."""
    return simhash.one_per_group(docs.select(*COLUMNS), SHINGLE, BITS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words or more that start anywhere else; n_chars follows the text."""
    out = suffix_dedup.remove_repeats(docs.select(*COLUMNS), REPEAT, as_text=True, words=REPEAT_WORDS)
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    return out.select("doc_id", text.alias("text"), "lang", "source",
                      F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids): the token ids, and proof that they decode."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    # Written in between, so that a task needs one Python worker: idle ones stay beside the stages that follow.
    ids = store(bpe.encode(docs, path, pattern), "pipeline-ids")
    return bpe.digests(bpe.decode(ids, path, pattern), "ids")


STAGES = [
    ("language_id", keep_languages),
    ("simhash", keep_one_near_copy),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("byte_bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
