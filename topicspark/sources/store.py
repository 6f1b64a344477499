"""The topic-partitioned article table and the chunk index on parquet
(S8-S11, W2, A4).

One table ``articles`` partitioned by ``topic`` replaces the original one
database per topic: a topic scan is a partition-pruned read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark.operators.numbering import number_rows
from topicspark.operators.sizing import bounded_broadcast
from topicspark.schemas import ARTICLE, CHUNK_INDEX
from topicspark.sources import id_log
from topicspark.sources.id_log import is_absent


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """All topic tables (empty frame of the article schema when absent)."""
    try:
        return spark.read.schema(ARTICLE).parquet(path).select(*ARTICLE.fieldNames())
    except AnalysisException as e:
        if not is_absent(e):
            raise
        return spark.createDataFrame([], ARTICLE)


def scan_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """One topic's rows; the filter prunes partitions."""
    return read_articles(spark, path).filter(F.col("topic") == F.lit(topic))


def max_ids(existing: DataFrame) -> DataFrame:
    """A4: (topic, max_id) -- 0 for a topic without rows."""
    return existing.groupBy("topic").agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("max_id"))


def allocate_ids(rows: DataFrame, existing: DataFrame | None, order: list[str],
                 base: DataFrame | None = None, base_checked: bool = False) -> DataFrame:
    """Per topic, ids max(id)+1 upward in ``order`` (the input order).

    Numbering is skew-safe (see ``number_rows``); the base comes from a
    one-row-per-topic table: ``base`` (topic, max_id) when given, else the
    max ids of ``existing``. ``base_checked`` says ``base`` was already
    materialised and size-checked (``bounded_broadcast``)."""
    numbered = number_rows(rows, ["topic"], order, "_n")
    if base is None:
        if existing is None:
            return numbered.withColumn("id", F.col("_n")).drop("_n")
        base = max_ids(existing)
    side = base if base_checked else bounded_broadcast(base)
    return (numbered.join(side, "topic", "left")
                    .withColumn("id", (F.coalesce(F.col("max_id"), F.lit(0)) + F.col("_n")).cast("long"))
                    .drop("_n", "max_id"))


# Rows of one topic whose key falls in the same block of this many ids go to
# the same writer task, as far as its byte target allows.
WRITE_BLOCK = 1_000_000


def cluster_for_write(df: DataFrame, keys: list[str], block: int = WRITE_BLOCK) -> DataFrame:
    """Cluster rows before a ``partitionBy('topic')`` write.

    ``keys`` = (topic, numeric key, ...). Rows are rebalanced on
    (topic, floor(key / block)) and sorted within partitions: a hot topic is
    spread over many tasks (``repartition('topic')`` would give it one), a
    task writes few topics, and files hold sorted runs of ids whose row-group
    min/max make id lookups cheap. A block is a number of ids, but writers
    are sized by bytes: from the measured sizes of the shuffle, partitions
    over ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (long texts) are
    split and small ones put together. Unlike a range partitioning, this
    needs no sampling pass over an expensive input."""
    topic, key = keys[0], keys[1]
    return (df.withColumn("_block", F.floor(F.col(key) / F.lit(block))).hint("rebalance", topic, "_block")
              .sortWithinPartitions(*keys).drop("_block"))


def append_articles(df: DataFrame, path: str, mode: str = "append", load: str | None = None) -> None:
    """Routed append: each row lands in its topic's partition, below it in
    that of its load. A load that comes again under its name replaces its own
    rows. With ``mode="overwrite"`` the whole table is replaced, whatever the
    session's partition overwrite mode."""
    rows = (cluster_for_write(df.select(*ARTICLE.fieldNames()), ["topic", "id"])
            .withColumn("load", F.lit(load or f"rows-{uuid.uuid4().hex}")))
    whole = mode == "overwrite" or load is None
    (rows.write.mode(mode if whole else "overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
         .partitionBy("topic", "load").parquet(path))


def write_chunk_index(df: DataFrame, path: str) -> None:
    """Store chunk index rows; topics present in ``df`` are replaced
    (dynamic partition overwrite), other topics stay."""
    (cluster_for_write(df.select(*[f.name for f in CHUNK_INDEX.fields]), ["topic", "chunkStart"])
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("topic").parquet(path))


def read_chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """(chunkStart, chunkEnd, topic, summary, updatedAt, id)."""
    return spark.read.schema(CHUNK_INDEX).parquet(path).select(
        "chunkStart", "chunkEnd", "topic", "summary", "updatedAt", "id")


def read_max_ids(spark: SparkSession, table: str) -> DataFrame | None:
    """The reserved max id per topic of ``table`` (one row per topic), or
    None when no load has reserved ids yet."""
    return id_log.reserved(spark, table)


def reserve_ids(spark: SparkSession, table: str, counts: DataFrame, name: str | None = None, number: int = 0) -> DataFrame:
    """Reserve ids for ``counts`` (topic, n) rows of a load in the table's id
    log (see ``id_log``); (topic, max_id) as before them. The first load reads
    the max ids of the rows that are there."""
    return id_log.reserve(spark, table, counts, lambda: max_ids(read_articles(spark, table)), name, number)
