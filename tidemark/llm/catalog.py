"""The operators' queries (opN_<name>) over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, decontaminate, language_crf, oracle, quality_rules, sharding, simhash, spelling, suffix_dedup, token_shards, toxicity, url_filter, warc, whitening
from tidemark.llm.common import bare, fresh_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


@query("op1_simhash")
def _(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op6_bpe")
def _(spark, sf):
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf, "documents"), path, pattern), path, pattern))


@query("op9_suffix_dedup", oracle.SUFFIX_DEDUP)
def _(spark, sf):
    out = suffix_dedup.remove_repeats(bare(table(spark, sf, "documents"), "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_quality_rules", oracle.QUALITY_RULES)
def _(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents")).drop("rejected_by")


@query("op4_toxicity")
def _(spark, sf):
    return toxicity.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op5_language_crf")
def _(spark, sf):
    return language_crf.judge(table(spark, sf, "documents"))


@query("op2_warc", oracle.WARC)
def _(spark, sf):
    path = fresh_path(spark, "warc")
    warc.write(warc.page_records(table(spark, sf, "pages")), path)
    return warc.page_digests(warc.read(spark, path, payloads="response"))


@query("op10_decontamination")
def _(spark, sf):
    return decontaminate.judge(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_url_filter")
def _(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"))


ORDER_KEY = "epoch-1"


@query("op8_training_order")
def _(spark, sf):
    docs, path = table(spark, sf, "documents"), fresh_path(spark, "token-shards")
    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        encode = token_shards.library_encoder(f.read(), public_tokenizers.PATTERN)
    found = token_shards.read(spark, token_shards.write(docs, path, encode, ORDER_KEY))
    return found.withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")


@query("op11_whitening")
def _(spark, sf):
    rows = table(spark, sf, "embeddings")
    model = whitening.fit(rows)
    return whitening.components(rows, model, "vec_id").withColumn("deviation", F.col("deviation").cast("bigint"))


@query("op12_sharding")
def _(spark, sf):
    placed = sharding.placements(table(spark, sf, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op13_spelling")
def _(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
