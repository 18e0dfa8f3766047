"""From raw documents to balanced shards: each stage is one operator, and its output is written and read again.

Nulls: documents without a text or with an empty one fail the quality rules; a null doc_id is kept and is an id of its
own, a null source a source of its own. Very long texts pass whole. Repeated rows are near duplicates of each other, so
one stays. Columns beyond those of documents are carried along whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import common, op1_kd_shards, op6_decontaminate, op7_quality_rules, op8_mixing, op9_simhash

#: Near duplicates have a Jaccard similarity of 0.8 or more over five words.
WORDS, SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents, without their failing lines."""
    return op7_quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return op9_simhash.near_dedup(spark, docs, size=WORDS, similarity=SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return op6_decontaminate.drop_contaminated(spark, docs, common.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return op8_mixing.mixed(spark, docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with all their columns, and the shard and slot of each."""
    return op1_kd_shards.sharded(spark, docs)


STAGES = [("quality rules", quality), ("simhash near-dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: Fingerprints, Pareto ranks and k-d cuts can't be expressed in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's Parquet output is the next one's input."""
    scratch = common.Scratch(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            scratch.drop(f"stage{i - 1}")
    return docs
