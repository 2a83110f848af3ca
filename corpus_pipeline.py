"""Corpus pipeline: rules, classifier, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns
of ``docs`` (the last: pieces of packed sequences); a stage's result is
written as Parquet and read again as the next one's ``docs``.

Null, empty and very long texts, ties, repeated rows, empty tables and columns
of any name are handled as the operators state: a null text is empty, fails
the base rules and goes; an empty table stays empty through every stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.llm import op1_simhash, op5_packing, op7_rules, op8_mixing, op10_quality
from crashlake.llm.common import held_out, scratch, stage, table, unstage

#: Least quality score that stays.
LEAST_QUALITY = 0.3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and are no outlier of their language and source."""
    return op7_rules.judge(op7_rules.with_statistics(docs)).where("kept").select("doc.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of at least LEAST_QUALITY. The model learns from the labelled rows of
    the whole corpus: those that the rules rejected show it what bad text is."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = op10_quality.train(table(spark, sf_dir, "documents"), labels)
    scored = docs.select(F.struct("*").alias("doc"), op10_quality.quality(F.col("text"), model, spark).alias("score"))
    return scored.where(F.col("score") >= LEAST_QUALITY).select("doc.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id."""
    return op1_simhash.deduplicate(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return op8_mixing.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 2048 ids."""
    return op5_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: Fingerprints, tokens and nearest neighbours are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        with scratch(spark):  # what the operator stages for itself goes with it
            done = stage(step(spark, docs, sf_dir), name, keep=True)
        unstage(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
