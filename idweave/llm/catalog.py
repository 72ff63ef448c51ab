"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from idweave.llm import (
    bloom_dedup,
    chat,
    collocations,
    crf_language,
    feistel,
    hard_negatives,
    license_rules,
    line_rules,
    mixing,
    ngram_join,
    oracle,
    packing,
    token_counts,
    warc,
)
from idweave.plans.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Only for the test tables; a user passes a secret of their own.
TEST_KEY = b"test tables only"


def op1_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_rules.recognise(docs).drop("text")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    read = chat.read_back(chat.format_conversations(rows))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return feistel.pseudonymised(docs, TEST_KEY)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    got = mixing.mixed(docs, corpus_pipeline.BUDGET, weights=corpus_pipeline.WEIGHTS)
    return got.drop("text")


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_rules.verdicts(docs, ["doc_id"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    return warc.archive_round_trip(spark, _table(spark, sf_dir, "pages"), folder).drop("url")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op8_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_language.identify(_table(spark, sf_dir, "documents"))


def op9_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bloom_dedup.mark_repeats(docs).drop("text")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer_path())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", F.when(F.col("label").isNotNull(), moved))
    return hard_negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES: dict[str, Query] = {
    "op1_license_rules": op1_license_rules,
    "op2_chat": op2_chat,
    "op3_feistel": op3_feistel,
    "op4_mixing": op4_mixing,
    "op5_line_rules": op5_line_rules,
    "op6_warc": op6_warc,
    "op7_ngram_join": op7_ngram_join,
    "op8_crf_language": op8_crf_language,
    "op9_bloom_dedup": op9_bloom_dedup,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = oracle.ORACLES
