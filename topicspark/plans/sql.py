"""SQL surface (Q1, Q2)."""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_VIEW = "test"


def _is_query(spark: SparkSession, text: str) -> bool:
    """Whether the parsed text holds no command and no insert at any depth."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException:
        return False
    jvm = spark.sparkContext._jvm
    logical = "org.apache.spark.sql.catalyst.plans.logical."
    refused = [jvm.java.lang.Class.forName(logical + c) for c in ("Command", "ParsedStatement")]
    todo = [plan]
    while todo:
        node = todo.pop()
        if any(c.isInstance(node) for c in refused):
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def topic_sql(spark: SparkSession, topic_rows: DataFrame, topic: str, text: str) -> DataFrame:
    """Q1: run a user query against one topic's table, visible as ``test``.

    ``topic_rows`` is the article table; the topic filter prunes partitions.
    Only queries are run (no DDL / DML)."""
    if not _is_query(spark, text):
        raise ValueError("only queries can be run against a topic table")
    topic_rows.filter(F.col("topic") == F.lit(topic)).createOrReplaceTempView(TOPIC_VIEW)
    return spark.sql(text)


def generated_table(spark: SparkSession, n: int, prefix: str = "Data ") -> DataFrame:
    """Q2: ``n`` rows (id, name = prefix || id) with a serial id from 1."""
    return spark.range(1, n + 1).select(F.col("id"), F.concat(F.lit(prefix), F.col("id").cast("string")).alias("name"))
