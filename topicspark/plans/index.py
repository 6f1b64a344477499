"""Build the chunk index for all topics in one job:
S9 (all topics) -> W1 -> T6 -> A10/A11 -> W4 -> S10."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark.operators.chunks import (
    DEFAULT_CHUNK_SIZE, assign_chunks, build_chunk_index, fold_chunks, ids_dense_from_one, index_ids,
)
from topicspark.operators.keywords import keyword_chunks
from topicspark.operators.numbering import running_offsets
from topicspark.operators.summarize import summarize
from topicspark.session import scratch_path
from topicspark.sources import store

#: Topics of changed chunks that go into the article scan as a literal list.
MAX_TOPIC_LIST = 200


def plan_keyword_index(rows: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE,
                       as_of: str = "2024-01-01 00:00:00",
                       topic_order: DataFrame | None = None,
                       chunk_counts: DataFrame | None = None) -> DataFrame:
    """Index rows whose summary is the chunk's keyword map as JSON, of
    ``rows`` (topic, id, keywords); a chunk without keywords has ``{}``."""
    chunks = keyword_chunks(rows, chunk_size)
    return index_ids(chunks, topic_order, chunk_counts).select(
        "id", F.col("chunk_start").alias("chunkStart"), F.col("chunk_end").alias("chunkEnd"), "topic",
        F.coalesce("keyword_json", F.lit("{}")).alias("summary"),
        F.to_timestamp(F.lit(str(as_of))).alias("updatedAt"))


def plan_index(articles: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE,
               as_of: str = "2024-01-01 00:00:00", method: str = "degree",
               topic_order: DataFrame | None = None,
               chunk_counts: DataFrame | None = None) -> DataFrame:
    """``method``: ``degree`` or ``textrank`` summaries, or ``keywords``."""
    if method == "keywords":
        return plan_keyword_index(articles, chunk_size, as_of, topic_order, chunk_counts)
    summ = summarize(articles, ["topic", "id"], method=method)
    return build_chunk_index(articles, summ, chunk_size, as_of, topic_order, chunk_counts)


def _stored_index(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return store.read_chunk_index(spark, path)
    except AnalysisException as e:
        if not store.is_absent(e):
            raise
        return None


def _at_full_places(index: DataFrame, counts: DataFrame) -> bool:
    """Whether every topic of ``index`` holds the ids that a build of all
    topics would give it; ``counts`` (topic, _nchunks) are all topics."""
    places = running_offsets(counts.withColumn("_tpos", F.col("topic")),
                             [F.col("_tpos").asc_nulls_last(), F.col("topic").asc()], "_nchunks", "_off")
    held = index.groupBy("topic").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                                      F.count(F.lit(1)).alias("n"))
    off = held.join(places.select("topic", "_nchunks", "_off"), "topic", "left").filter(
        F.col("_off").isNull() | (F.col("n") != F.col("_nchunks"))
        | (F.col("lo") != F.col("_off") + 1) | (F.col("hi") != F.col("_off") + F.col("n")))
    return off.limit(1).count() == 0


def build_index(spark: SparkSession, articles_path: str, index_path: str,
                chunk_size: int = DEFAULT_CHUNK_SIZE, as_of: str = "2024-01-01 00:00:00",
                topics: list[str] | None = None, method: str = "degree") -> DataFrame:
    """Summarise ``topics`` (all when None) and overwrite their index rows;
    listed topics without articles are skipped.

    A build of listed topics gives them the ids of a full build as long as
    the other topics of the stored index hold theirs (chunks of *all* topics
    are counted, key columns only). Otherwise (a topic has grown, or there is
    no index yet) they take ids above the stored maximum, in list order, so
    that ids stay unique."""
    arts = store.read_articles(spark, articles_path)
    if topics is None:
        idx = plan_index(arts, chunk_size, as_of, method)
    else:
        listed = arts.filter(F.col("topic").isin(topics))
        counts = arts.groupBy("topic").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(chunk_size)).cast("long").alias("_nchunks"))
        stored = _stored_index(spark, index_path)
        if stored is not None and _at_full_places(stored.filter(~F.col("topic").isin(topics)), counts):
            idx = plan_index(listed, chunk_size, as_of, method, chunk_counts=counts)
        else:
            top = 0 if stored is None else stored.agg(F.max("id")).first()[0] or 0
            order = spark.createDataFrame([(t, i) for i, t in enumerate(dict.fromkeys(topics))],
                                          "topic string, topic_pos long")
            idx = plan_index(listed, chunk_size, as_of, method, order,
                             counts.filter(F.col("topic").isin(topics)))
            idx = idx.withColumn("id", F.col("id") + F.lit(top))
    store.write_chunk_index(idx, index_path)
    return store.read_chunk_index(spark, index_path)


def prints_path(index_path: str) -> str:
    return index_path.rstrip("/") + "_prints"


def chunk_prints(articles: DataFrame, chunk_size: int, dense: bool) -> DataFrame:
    """(topic, chunk, chunk_start, chunk_end, n, p1, p2): what each chunk
    holds, as 128 bits over its rows' ids and texts."""
    cols = ["id", "question", "answer"]
    narrow = articles.select("topic", "id", F.xxhash64(*cols).alias("h1"), F.xxhash64(*cols[::-1], F.lit(1)).alias("h2"))
    return assign_chunks(narrow, chunk_size, dense=dense).groupBy("topic", "chunk").agg(
        F.min("id").cast("long").alias("chunk_start"), F.max("id").cast("long").alias("chunk_end"),
        F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("p1"), F.bit_xor("h2").alias("p2"))


def update_index(spark: SparkSession, articles_path: str, index_path: str,
                 chunk_size: int = DEFAULT_CHUNK_SIZE, as_of: str = "2024-01-01 00:00:00",
                 method: str = "degree") -> DataFrame:
    """Bring the index of all topics up to date: only chunks that are new, or
    whose rows have changed, are summarised (``method`` ``degree`` or
    ``textrank``); the others keep their stored summary and time. The ids are
    those of a full build, and only topics with a changed row are written.

    A table beside the index holds each chunk's print with a hash of the
    summary made from it. A stored summary counts only where both are as
    noted, so an update that ends half-way costs work, never a wrong summary."""
    arts = store.read_articles(spark, articles_path)
    base = scratch_path(spark, "update-index")
    dense = ids_dense_from_one(arts)
    prints = chunk_prints(arts, chunk_size, dense)
    prints.write.parquet(base + "/prints")
    prints = spark.read.schema(prints.schema).parquet(base + "/prints")
    stored = _stored_index(spark, index_path)
    marks = ["topic", "chunk", "chunk_start", "chunk_end", "n", "p1", "p2"]
    names = ["topic", "chunk", "chunk_start", "chunk_end", "summary", "updatedAt"]
    noted_schema = prints.schema.add("summary_hash", "long").add("method", "string")
    try:
        noted = spark.read.schema(noted_schema).parquet(prints_path(index_path)).filter(F.col("method") == F.lit(method))
    except AnalysisException as e:
        if not store.is_absent(e):
            raise
        noted = None
    if stored is None or noted is None:
        kept = spark.createDataFrame([], "topic string, chunk long, chunk_start long, chunk_end long, summary string, updatedAt timestamp")
    else:
        held = stored.select("topic", F.col("chunkStart").alias("chunk_start"), F.col("chunkEnd").alias("chunk_end"), "summary",
                             "updatedAt", F.xxhash64("summary").alias("summary_hash"))
        kept = prints.join(noted.drop("method"), marks).join(held, ["topic", "chunk_start", "chunk_end", "summary_hash"]).select(*names)
    changed = prints.join(kept, ["topic", "chunk"], "left_anti").select("topic", "chunk")
    changed.write.parquet(base + "/changed")
    changed = spark.read.schema(changed.schema).parquet(base + "/changed")
    topics = changed.select("topic").distinct().limit(MAX_TOPIC_LIST + 1).collect()
    mine = arts.filter(F.col("topic").isin([r.topic for r in topics])) if len(topics) <= MAX_TOPIC_LIST else arts
    if dense:
        mine = assign_chunks(mine, chunk_size, dense=True)
    else:
        mine = mine.join(assign_chunks(arts.select("topic", "id"), chunk_size, dense=False), ["topic", "id"])
    mine = mine.join(changed, ["topic", "chunk"], "left_semi")
    summaries = summarize(mine, ["topic", "chunk", "id"], method=method)
    made = fold_chunks(summaries).withColumn("updatedAt", F.to_timestamp(F.lit(str(as_of)))).select(*names)
    counts = prints.groupBy("topic").agg(F.count(F.lit(1)).alias("_nchunks"))
    rows = index_ids(made.unionByName(kept), None, counts).select(
        "id", F.col("chunk_start").alias("chunkStart"), F.col("chunk_end").alias("chunkEnd"), "topic", "summary", "updatedAt", "chunk")
    rows.write.parquet(base + "/index")  # the stored index is read for it
    rows = spark.read.schema(rows.schema).parquet(base + "/index")
    new = rows.drop("chunk")
    if stored is not None:
        moved = rows.join(stored.select("topic", "id", "chunkStart", "chunkEnd"), ["topic", "id", "chunkStart", "chunkEnd"], "left_anti")
        shrunk = (stored.groupBy("topic").count().join(rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n")), "topic")
                        .filter("count != n"))
        touched = changed.select("topic").union(moved.select("topic")).union(shrunk.select("topic")).distinct()
        touched.write.parquet(base + "/touched")
        new = new.join(spark.read.schema(touched.schema).parquet(base + "/touched"), "topic", "left_semi")
    store.write_chunk_index(new, index_path)
    (prints.join(rows.select("topic", "chunk", F.xxhash64("summary").alias("summary_hash")), ["topic", "chunk"])
           .withColumn("method", F.lit(method)).select(*noted_schema.fieldNames())
           .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(prints_path(index_path)))
    return store.read_chunk_index(spark, index_path)
