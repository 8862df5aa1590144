"""A corpus cleaned and encoded by five operators, each applied to what the one before it kept.

Every stage's output is written and read again. All but the last return the columns of documents, which may be more
than the five of the test tables and have any names. Null and empty texts pass all stages (their score is that of no word, they
have no lines, no set and no benchmark item, and no tokens). Rows that repeat in full are judged alike; the third
stage leaves one of them. An empty table gives an empty result after every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import bpe, decontaminate, line_dedup, near_dedup, toxicity
from furrow.llm.common import table, written
from furrow.llm.queries import vocabulary


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learned from the labelled ones of the learning fold."""
    classifier = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learnable())
    return toxicity.score(docs, classifier).where(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; a text of which nothing is left goes.

    n_chars follows the text where lines went, and is left as it was elsewhere.
    """
    cleaned = line_dedup.deduplicate_lines(docs)
    left = cleaned.where((F.col("n_removed") == 0) | (F.trim(F.col("text")) != ""))
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return left.withColumn("n_chars", length).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five words, 80 of 100) the document with the smallest id; null ids come last."""
    return near_dedup.one_of_each_group(docs).select(*docs.columns)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or with other numbers, names or units; null and empty ones stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the decoded bytes."""
    return bpe.digests(docs, *vocabulary())


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", remove_benchmark_leaks),
    ("bpe", encode),
]

# Toxicity is learned and BPE merges are not SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
