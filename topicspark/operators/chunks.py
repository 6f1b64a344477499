"""Chunking of topic tables and the chunk index.

A chunk is ``chunk_size`` consecutive rows of one topic in id order; chunks
never span topics. The chunk index holds one row per chunk: (id,
chunkStart, chunkEnd, topic, summary, updatedAt) where summary is the folded
text of the chunk's row summaries.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicspark.functions.text import fold_lines, normalize_line, render_line, row_id_of_line
from topicspark.operators.numbering import number_rows, running_offsets
from topicspark.operators.sizing import bounded_broadcast

DEFAULT_CHUNK_SIZE = 500


def ids_dense_from_one(articles: DataFrame, topic: str = "topic", id_col: str = "id") -> bool:
    """True when every topic's ids are exactly 1..n (what the loader writes):
    then a row's position in id order is its id. One small aggregate over
    the two key columns."""
    per = articles.groupBy(topic).agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"),
                                      F.count(F.lit(1)).alias("n"), F.countDistinct(id_col).alias("d"))
    bad = per.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))
                     | F.col("lo").isNull())
    return bad.limit(1).count() == 0


def assign_chunks(articles: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE,
                  topic: str = "topic", id_col: str = "id", dense: bool | None = None) -> DataFrame:
    """Add ``chunk`` (0-based) = (position in id order - 1) div size.

    When ids are dense from 1 per topic (``dense``, checked when None) the
    position is the id and no numbering is needed; otherwise positions come
    from the skew-safe ``number_rows``."""
    if dense is None:
        dense = ids_dense_from_one(articles, topic, id_col)
    if dense:
        return articles.withColumn(
            "chunk", F.floor((F.col(id_col) - 1) / F.lit(chunk_size)).cast("long"))
    numbered = number_rows(articles, [topic], [id_col], "_pos")
    return (numbered.withColumn("chunk", F.floor((F.col("_pos") - 1) / F.lit(chunk_size)).cast("long"))
                    .drop("_pos"))


def chunk_bounds(chunked: DataFrame) -> DataFrame:
    """A10: first and last id of every chunk."""
    return chunked.groupBy("topic", "chunk").agg(
        F.min("id").cast("long").alias("chunk_start"), F.max("id").cast("long").alias("chunk_end"))


def fold_chunks(chunked_summaries: DataFrame) -> DataFrame:
    """A10 + A11: (topic, chunk, chunk_start, chunk_end, summary) from rows of
    (topic, chunk, id, summary). ``collect_list`` is bounded by chunk size."""
    return (chunked_summaries.groupBy("topic", "chunk")
            .agg(F.min("id").cast("long").alias("chunk_start"),
                 F.max("id").cast("long").alias("chunk_end"),
                 fold_lines(F.collect_list(F.struct(F.col("id").cast("long").alias("id"),
                                                    render_line("id", "summary").alias("line"))))
                 .alias("summary")))


def index_ids(chunks: DataFrame, topic_order: DataFrame | None = None,
              chunk_counts: DataFrame | None = None) -> DataFrame:
    """Global index id over (topic order, chunk), 1-based.

    ``topic_order`` (topic, topic_pos) gives the order of topics (the topic
    list order); by default topics are ordered by name. Offsets come from a
    per-topic chunk count table (one row per topic), so the big table is
    never numbered in one task. ``chunk_counts`` (topic, _nchunks) may be
    given when it is cheaper to get than from ``chunks`` (the chunk
    assignment alone decides it).
    """
    per_topic = (chunk_counts if chunk_counts is not None else
                 chunks.groupBy("topic").agg(F.count(F.lit(1)).alias("_nchunks")))
    if topic_order is None:
        per_topic = per_topic.withColumn("_tpos", F.col("topic"))
    else:
        per_topic = per_topic.join(topic_order.select("topic", F.col("topic_pos").alias("_tpos")),
                                   "topic", "left")
    offs = running_offsets(per_topic.select("topic", "_tpos", "_nchunks"),
                           [F.col("_tpos").asc_nulls_last(), F.col("topic").asc()],
                           "_nchunks", "_off").select("topic", "_off")
    # One row per topic; broadcast after a counted size check.
    return (chunks.join(bounded_broadcast(offs), "topic")  # inner: only the topics of ``chunks``
                  .withColumn("id", (F.col("_off") + F.col("chunk") + 1).cast("long"))
                  .drop("_off"))


def build_chunk_index(articles: DataFrame, summaries: DataFrame,
                      chunk_size: int = DEFAULT_CHUNK_SIZE,
                      as_of: _dt.datetime | str = "2024-01-01 00:00:00",
                      topic_order: DataFrame | None = None,
                      chunk_counts: DataFrame | None = None) -> DataFrame:
    """T9 core: chunk -> fold row summaries -> index rows.

    ``summaries`` is (topic, id, summary) for the rows of ``articles``.
    ``chunk_counts`` (topic, _nchunks) of *all* topics makes the index ids of
    a partial rebuild equal those of a full build.
    """
    keys = articles.select("topic", "id")
    dense = ids_dense_from_one(keys)
    chunked = assign_chunks(keys, chunk_size, dense=dense)
    if dense:
        # Every article has one summary row: the chunk follows from the id,
        # so the summaries need no join with the chunk assignment.
        rows = assign_chunks(summaries, chunk_size, dense=True)
    else:
        rows = chunked.join(summaries, ["topic", "id"], "left")
    folded = fold_chunks(rows)
    # Chunks per topic follow from the assignment alone: the offsets table is
    # computed without running the summaries.
    counts = (chunk_counts if chunk_counts is not None else
              chunked.groupBy("topic").agg((F.max("chunk") + 1).alias("_nchunks")))
    with_ids = index_ids(folded, topic_order, counts)
    return with_ids.select(
        "id", F.col("chunk_start").alias("chunkStart"), F.col("chunk_end").alias("chunkEnd"),
        "topic", "summary", F.to_timestamp(F.lit(str(as_of))).alias("updatedAt"))


def summary_lines(chunk_index: DataFrame, min_len: int = 5) -> DataFrame:
    """F9 + F10: every kept line of every chunk summary:
    (topic, chunk_start, chunk_end, line_no, row_text, row_id).

    Lines are lower-cased and stripped; lines of ``min_len`` characters or
    fewer are dropped.
    """
    return (chunk_index.select("topic", F.col("chunkStart").alias("chunk_start"),
                               F.col("chunkEnd").alias("chunk_end"),
                               F.posexplode(F.split("summary", "\n")).alias("line_no", "raw"))
            .select("topic", "chunk_start", "chunk_end", "line_no",
                    normalize_line("raw").alias("row_text"))
            .filter(F.length("row_text") > min_len)
            .withColumn("row_id", row_id_of_line("row_text")))
