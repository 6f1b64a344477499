"""Clean-up, validation and reshaping of input rows."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicspark.functions.text import PLACEHOLDER_KEYWORDS
from topicspark.operators.numbering import number_rows


def rename_qna(raw: DataFrame, question: str = "Question", answer: str = "Answer",
               category: str = "Category") -> DataFrame:
    """Select and rename to (question, answer, topic)."""
    return raw.select(F.col(question).alias("question"), F.col(answer).alias("answer"),
                      F.col(category).alias("topic"))


def drop_null_topic(df: DataFrame) -> DataFrame:
    """P2."""
    return df.filter(F.col("topic").isNotNull())


def slug_topic(df: DataFrame) -> DataFrame:
    """Every space in the topic becomes a dash."""
    return df.withColumn("topic", F.replace(F.col("topic"), F.lit(" "), F.lit("-")))


def paragraphs_to_input(raw: DataFrame, paragraph: str = "paragraph",
                        topic: str = "topic", keep: list[str] | None = None) -> DataFrame:
    """Paragraph rows as (question = '', answer, topic), plus ``keep``."""
    return raw.select(*(keep or []), F.lit("").alias("question"), F.col(paragraph).alias("answer"),
                      F.col(topic).alias("topic"))


def clean_qna(raw: DataFrame) -> DataFrame:
    """P1 -> P2 -> P3: the cleaned input of a Q&A file."""
    return slug_topic(drop_null_topic(rename_qna(raw)))


def clean_paragraphs(raw: DataFrame) -> DataFrame:
    """P2 -> P3 -> P4 for paragraph files."""
    return paragraphs_to_input(slug_topic(drop_null_topic(raw)))


def topic_filter(df: DataFrame, topic: str) -> DataFrame:
    """P5."""
    return df.filter(F.col("topic") == F.lit(topic))


def id_range(df: DataFrame, start: int, end: int) -> DataFrame:
    """``get_chunk``: ids in [start, end]."""
    return df.filter(F.col("id").between(start, end))


def point_lookup(df: DataFrame, topic: str, id_: int) -> DataFrame:
    """P7."""
    return df.filter((F.col("topic") == F.lit(topic)) & (F.col("id") == F.lit(id_)))


def classify(df: DataFrame, topic_col: str = "topic", labels: DataFrame | None = None,
             key: str | None = None) -> DataFrame:
    """The topic is the third input column (pass-through). A label table
    (key, topic) may be joined in instead."""
    if labels is None:
        return df.withColumn("topic", F.col(topic_col))
    return df.drop("topic").join(labels.select(key, "topic"), key, "left")


REJECT_NO_TOPIC = "missing topic column"
REJECT_EMPTY_TOPIC = "empty topic"
REJECT_EMPTY_ROW = "empty row"


def validate(df: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (null for good rows).

    CSV records carry their number of fields (``_fields``): a blank record is
    empty, one of fewer than three fields lacks the topic column, and a blank
    topic is rejected. Rows of a table have no records: one whose fields are
    all null is empty, a null topic means the column is missing."""
    blank = F.btrim(F.coalesce("topic", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == ""
    if "_fields" in df.columns:
        empty, missing = F.col("_fields") == 0, F.col("_fields") < 3
    else:
        empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in ("question", "answer", "topic")])
        missing = F.col("topic").isNull()
    return df.withColumn(
        "reject_reason",
        F.when(empty, F.lit(REJECT_EMPTY_ROW)).when(missing, F.lit(REJECT_NO_TOPIC)).when(blank, F.lit(REJECT_EMPTY_TOPIC)))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    v = validate(df)
    return (v.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            v.filter(F.col("reject_reason").isNotNull()))


def placeholder_keywords() -> F.Column:
    """P10."""
    return F.array(*[F.lit(k) for k in PLACEHOLDER_KEYWORDS])


def to_node_rows(df: DataFrame, as_of: str | _dt.datetime) -> DataFrame:
    """(topic, question, answer, ...) -> node row columns with the
    placeholder keywords and the load time ``as_of`` (a parameter, never
    read from the clock inside a query)."""
    return df.select(
        "topic", F.coalesce(F.col("question"), F.lit("")).alias("question"),
        F.coalesce(F.col("answer"), F.lit("")).alias("answer"),
        placeholder_keywords().alias("keywords"),
        F.to_timestamp(F.lit(str(as_of))).alias("updatedAt"),
        *[c for c in df.columns if c not in ("topic", "question", "answer")])


def column_names(df: DataFrame) -> DataFrame:
    """(ordinal, name, type) of a table's columns."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal long, name string, type string")


def any_null(df: DataFrame, cols: list[str] | None = None) -> F.Column:
    """P13."""
    cols = cols or df.columns
    return reduce(or_, [F.col(c).isNull() for c in cols])


def with_row_index(df: DataFrame, order: list[str], name: str = "index") -> DataFrame:
    """0-based row index over an explicit order key (not file order)."""
    return number_rows(df, [], order, name).withColumn(name, F.col(name) - 1)
