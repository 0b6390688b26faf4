"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept: toxic documents go, then poor ones, then near duplicates;
the rest is mixed by source and packed. `run` stores each stage's result in the shared folder, so a
lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import mixing, packing, quality, simhash, toxicity
from aerolith.llm.common import table
from aerolith.llm.queries import tokenizer_path
from aerolith.session import stored
from workload.scratch import ensure_scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity cutoff; the classifier learns from the labelled ones given."""
    ensure_scratch(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs that the labelled ones given allow."""
    ensure_scratch(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    ensure_scratch(spark)
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    ensure_scratch(spark)
    return mixing.repeat_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: its tokens' checksum, its sequence and its place there."""
    ensure_scratch(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_good),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Learned scores, XXH64 and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
