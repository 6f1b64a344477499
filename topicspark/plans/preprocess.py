"""Preprocess plans: a raw headed CSV to the cleaned headerless CSV and the topic list.

P1-P4 between S2/S3 and S5/S6. Rows without a topic are dropped, spaces in
topics become dashes. The topic list is the distinct topics of the cleaned
rows, read from the raw file's topic column alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicspark.operators.prepare import clean_paragraphs, clean_qna
from topicspark.sources import csv_io


def _write(cleaned: DataFrame, csv_path: str, topics_path: str) -> None:
    csv_io.write_input_csv(cleaned, csv_path)
    csv_io.write_topics(cleaned, topics_path)


def preprocess_qna(spark: SparkSession, source: str, csv_path: str, topics_path: str,
                   multi_line: bool = False) -> None:
    """Columns Question, Answer and Category of ``source``."""
    raw = csv_io.read_headed_csv(spark, source, ["Question", "Answer", "Category"], multi_line)
    _write(clean_qna(raw), csv_path, topics_path)


def preprocess_paragraphs(spark: SparkSession, source: str, csv_path: str, topics_path: str,
                          multi_line: bool = False) -> None:
    """Columns paragraph and topic of ``source``; the question is empty."""
    raw = csv_io.read_headed_csv(spark, source, ["paragraph", "topic"], multi_line)
    _write(clean_paragraphs(raw), csv_path, topics_path)
