"""The test tables mapped onto this package's data model.

``articles``  documents: topic = source, id = position in doc_id order
              within the source, question = '', answer = text.
``raw_qna``   conversations: a user turn followed by an assistant turn gives
              (Question, Answer); Category = 'Topic ' || conv_id % 10.
``raw_wiki``  documents left join labels: paragraph = text, topic =
              'quality ' || quality, null where unlabelled.
``topics``    distinct sources plus 'ghost', a topic without rows.
``keyword rows`` part: id = p_partkey, topic = p_brand, keywords =
              split(p_type, ' ').
``queries``   benchmark items (qid = item_id, query = text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark.functions.text import PLACEHOLDER_KEYWORDS
from topicspark.operators.numbering import number_rows

# Fixed values of the fixtures.
AS_OF = "2024-01-01 00:00:00"
GHOST_TOPIC = "ghost"
FIXTURE_CHUNK_SIZE = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """(topic, id, question, answer, keywords, updatedAt)."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"), "doc_id", F.col("text").alias("answer"))
    numbered = number_rows(docs, ["topic"], ["doc_id"], "id")
    return numbered.select(
        "topic", "id", F.lit("").alias("question"), "answer",
        F.array(*[F.lit(k) for k in PLACEHOLDER_KEYWORDS]).alias("keywords"),
        F.to_timestamp(F.lit(as_of)).alias("updatedAt"))


def raw_qna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Question, Answer, Category): user turn + the assistant turn after it.

    The pairing is a join on (conv_id, turn + 1) -- keyed by the unique turn,
    so a very long conversation is not one task."""
    conv = table(spark, sf_dir, "conversations")
    u = conv.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("nturn"), F.col("text").alias("Question"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("nturn"), F.col("text").alias("Answer"))
    return u.join(a, ["conv_id", "nturn"]).select(
        "Question", "Answer",
        F.concat(F.lit("Topic "), (F.col("conv_id") % 10).cast("string")).alias("Category"),
        "conv_id", F.col("nturn").alias("turn"))


def raw_wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paragraph, topic, doc_id), topic null where a document is unlabelled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("paragraph"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        "paragraph",
        F.when(F.col("quality").isNotNull(),
               F.concat(F.lit("quality "), F.col("quality").cast("string"))).alias("topic"),
        "doc_id")


def expected_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic): distinct sources plus the ghost topic."""
    src = table(spark, sf_dir, "documents").select(F.col("source").alias("topic")).distinct()
    ghost = spark.range(1).select(F.lit(GHOST_TOPIC).alias("topic"))
    return src.unionByName(ghost).distinct()


def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic, id, keywords) from part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("topic"), F.col("p_partkey").alias("id"),
        F.split("p_type", " ").alias("keywords"))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, query) from benchmark."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("query"))
