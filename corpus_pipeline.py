"""Corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; the last returns a row of token
figures for each row that the mixing stage gave (a repeated document has as
many rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import bpe_prefix, host_rules, jaccard_join, line_dedup, queries, soft_mixing
from llm.tables import ship, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return host_rules.keep_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_dedup.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return soft_mixing.mixer(docs, table(spark, sf_dir, "labels")).mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe_prefix.encode_documents(docs, queries.vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixing),
    ("bpe", encoding),
]

#: Patience alignment, the fitted mix and BPE have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
