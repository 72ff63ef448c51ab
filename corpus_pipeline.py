"""From raw documents to packed sequences, in five stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from idweave.llm import bloom_dedup, line_rules, mixing, ngram_join, packing
from idweave.plans.scratch import scratch_dir

#: Tokens of the mix: four fifths of what there is, before epochs.
BUDGET = "all_tokens * 4 div 5"
#: Weights by node name; all others have 1. German is asked for beyond its supply in places.
WEIGHTS = {"lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects leave; frequent lines are cut from the rest."""
    return line_rules.cleaned(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return bloom_dedup.without_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return ngram_join.one_of_each_group(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix reads a document."""
    return mixing.repeated_by_epoch(docs, BUDGET, weights=WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", packed)]

#: Packing by a tokenizer isn't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if n == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{n}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{n}")
    return docs
