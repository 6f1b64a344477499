"""Registered queries: summaries, chunk index and search (T, W1, A10, A11, F9-F11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark import oracle as O
from topicspark.operators.chunks import build_chunk_index, summary_lines
from topicspark.operators.search import fetch_articles, relevant_lines, score_pairs, top_hits
from topicspark.operators.summarize import summarize
from topicspark.registry import register
from topicspark.sources import fixtures as fx

CHUNK = fx.FIXTURE_CHUNK_SIZE


def _index(spark: SparkSession, sf: str):
    art = fx.articles(spark, sf)
    summ = summarize(art, ["topic", "id"])
    return art, build_chunk_index(art, summ, CHUNK, fx.AS_OF)


@register("T6", O.sql("SELECT topic, id, summary FROM summaries", "summaries"))
def t6_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Extractive summary (degree centrality, top 3 sentences) of every article."""
    return summarize(fx.articles(spark, sf), ["topic", "id"])


@register("T9", O.sql("SELECT id, chunkStart, chunkEnd, topic, summary, "
                      "strftime(updatedAt, '%Y-%m-%d %H:%M:%S') AS updatedAt FROM chunk_index",
                      "chunk_index"))
def t9_build_index(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk index of all topics (chunk size 10)."""
    _, ci = _index(spark, sf)
    return ci.withColumn("updatedAt", F.date_format("updatedAt", "yyyy-MM-dd HH:mm:ss"))


@register("F9", O.sql("SELECT topic, chunk_start, chunk_end, line_no, row_text, row_id FROM lines",
                      "lines"))
def f9_summary_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Kept lines of every chunk summary, lower-cased and stripped, with row id."""
    _, ci = _index(spark, sf)
    return summary_lines(ci)


@register("T1", O.sql("SELECT qid, topic, chunk_start, chunk_end, line_no, "
                      "round(score, 6) AS score FROM scored", "scored"))
def t1_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """TF-IDF cosine of every benchmark item against every summary line sharing a term."""
    _, ci = _index(spark, sf)
    return score_pairs(fx.queries(spark, sf), summary_lines(ci), carry=[]).select(
        "qid", "topic", "chunk_start", "chunk_end", "line_no", "score")


@register("T3", O.sql("SELECT qid, round(score, 6) AS score, row_text, row_id, chunk_start, "
                      "chunk_end, topic, line_no FROM relevant", "relevant"))
def t3_relevant(spark: SparkSession, sf: str) -> DataFrame:
    """All summary lines scoring above 0.5 for any benchmark item."""
    _, ci = _index(spark, sf)
    return relevant_lines(fx.queries(spark, sf), summary_lines(ci))


@register("T2", O.sql("""
  SELECT qid, topic, chunk_start, chunk_end, count(*) AS n_lines,
         round(max(score), 6) AS best_score
  FROM relevant GROUP BY ALL""", "relevant"))
def t2_relevant_per_chunk(spark: SparkSession, sf: str) -> DataFrame:
    """Per (query, chunk): number of lines above 0.5 and the best score."""
    _, ci = _index(spark, sf)
    rel = relevant_lines(fx.queries(spark, sf), summary_lines(ci))
    return rel.groupBy("qid", "topic", "chunk_start", "chunk_end").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("score").alias("best_score"))


@register("L2", O.sql("SELECT qid, rank, round(score, 6) AS score, row_text, topic, chunk_start "
                      "FROM hits", "hits"))
def l2_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 relevant lines per benchmark item."""
    _, ci = _index(spark, sf)
    rel = relevant_lines(fx.queries(spark, sf), summary_lines(ci))
    return top_hits(rel, 5).select("qid", "rank", "score", "row_text", "topic", "chunk_start")


_T5_SQL = O.sql("""
  SELECT h.qid, h.rank, round(h.score, 6) AS score, h.row_text, a.answer,
         h.chunk_start, h.chunk_end, h.topic
  FROM hits h JOIN articles a ON a.topic = h.topic AND a.id = h.row_id""", "hits", "articles")


@register("T5", _T5_SQL)
def t5_smart_query(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: articles stored, index built and stored with its search index, then
    every benchmark item searched against it (score, top 5, article lookup)."""
    from topicspark.operators.search import search_index, write_search_index
    from topicspark.session import scratch_path
    from topicspark.sources import store
    base = scratch_path(spark, "t5")
    store.append_articles(fx.articles(spark, sf), base + "/articles", mode="overwrite")
    arts = store.read_articles(spark, base + "/articles")
    summ = summarize(arts, ["topic", "id"])
    store.write_chunk_index(build_chunk_index(arts, summ, CHUNK, fx.AS_OF), base + "/index")
    write_search_index(spark.read.parquet(base + "/index"), base + "/terms", base + "/lines")
    return search_index(fx.queries(spark, sf), base + "/terms", base + "/lines", arts)


@register("T4", _T5_SQL)
def t4_find_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Top-5 hits of every benchmark item (scored straight from a chunk index)
    joined to their full articles."""
    art, ci = _index(spark, sf)
    q = fx.queries(spark, sf)
    n_q = q.count()
    hits = top_hits(relevant_lines(q, summary_lines(ci), n_queries=n_q), 5)
    return fetch_articles(hits, art, bound=5 * n_q).select(
        "qid", "rank", "score", "row_text", "answer", "chunk_start", "chunk_end", "topic")


@register("S10", O.sql("SELECT id, chunkStart, chunkEnd, topic, summary, "
                       "strftime(updatedAt, '%Y-%m-%d %H:%M:%S') AS updatedAt FROM chunk_index",
                       "chunk_index"))
def s10_store_index(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk index stored (dynamic partition overwrite by topic) and read back;
    the topics are stored twice to show that a rebuild replaces, not appends."""
    from topicspark.session import scratch_path
    from topicspark.sources import store
    path = scratch_path(spark, "s10")
    _, ci = _index(spark, sf)
    store.write_chunk_index(ci, path)
    store.write_chunk_index(spark.read.parquet(path).select(*ci.columns), path + "-2")
    store.write_chunk_index(spark.read.parquet(path + "-2").select(*ci.columns), path)
    back = spark.read.parquet(path)
    return back.select("id", "chunkStart", "chunkEnd", F.col("topic").cast("string"), "summary",
                       F.date_format("updatedAt", "yyyy-MM-dd HH:mm:ss").alias("updatedAt"))


@register("S11", O.sql("SELECT chunkStart AS chunkstart, chunkEnd AS chunkend, topic, summary, "
                       "strftime(updatedAt, '%Y-%m-%d %H:%M:%S') AS updatedat FROM chunk_index",
                       "chunk_index"))
def s11_scan_index(spark: SparkSession, sf: str) -> DataFrame:
    """Scan of the stored chunk index: chunkstart, chunkend, topic, summary, updatedat."""
    from topicspark.session import scratch_path
    from topicspark.sources import store
    path = scratch_path(spark, "s11")
    _, ci = _index(spark, sf)
    store.write_chunk_index(ci, path)
    s = store.read_chunk_index(spark, path)
    return s.select(F.col("chunkStart").alias("chunkstart"), F.col("chunkEnd").alias("chunkend"),
                    "topic", "summary", F.date_format("updatedAt", "yyyy-MM-dd HH:mm:ss").alias("updatedat"))
