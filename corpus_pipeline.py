"""Corpus pipeline: documents in, training-order token shards out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; all but the
last return the columns of ``documents``.

Edge cases are those of the operators; in particular null and blank texts
pass the filters (no words to judge), and an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, mixing, quality, simhash, token_output
from strata.llm.common import staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance weights accept as like the good ones."""
    return quality.keep_target_like(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_per_class(docs, shingle_words=4, max_bits=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.resample(docs)


def token_output_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token shards; a row per sequence with its slot."""
    sequences, _, _ = token_output.materialise(docs)
    return sequences.select("slot", "shard", F.col("ids").alias("doc_ids"), "n_tokens", F.col("sha256").alias("ids_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_output_stage),
]

ORACLE_SQL = None  # hashes, models and a tokenizer are beyond SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").replace("/", ""))
    return docs
