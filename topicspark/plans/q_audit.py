"""Registered queries: audits, joins, windows, sorts and set operations
(A1-A11, J1-J5, W1, W3, W4, L1, L3, L5, X1, X2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark import oracle as O
from topicspark.operators import audit as A
from topicspark.operators.chunks import assign_chunks, chunk_bounds, fold_chunks, summary_lines
from topicspark.operators.search import fetch_articles, relevant_lines, term_counts, top_hits
from topicspark.operators.summarize import summarize
from topicspark.plans.q_ingest import _input, _stored
from topicspark.plans.q_search import CHUNK, _index
from topicspark.operators.numbering import running_offsets
from topicspark.operators.sizing import bounded_broadcast
from topicspark.registry import register
from topicspark.sources import fixtures as fx

TS = "yyyy-MM-dd HH:mm:ss"


def _gapped(ci: DataFrame) -> DataFrame:
    """The chunk index with gaps: the topic at position p (by name, from 1)
    loses its chunk number p (0-based), where it has one."""
    topics = ci.select("topic").distinct().withColumn("_one", F.lit(1))
    tpos = running_offsets(topics, [F.col("topic").asc()], "_one", "_before").select(
        "topic", (F.col("_before") + 1).alias("tpos"))
    return (ci.join(bounded_broadcast(tpos), "topic")
              .filter(F.col("chunkStart") != F.col("tpos") * CHUNK + 1)
              .drop("tpos"))


@register("A1", O.sql("SELECT count(*) AS n_rows FROM articles", "articles"))
def a1_count(spark: SparkSession, sf: str) -> DataFrame:
    """Row count of the article table."""
    return A.row_count(fx.articles(spark, sf))


@register("A2", O.sql("SELECT topic, count(*) AS n_rows FROM input GROUP BY topic", "input"))
def a2_rows_per_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Input rows per topic, most first."""
    return A.rows_per_topic(_input(spark, sf))


@register("A3", O.sql("SELECT count(DISTINCT topic) AS n_topics FROM input", "input"))
def a3_distinct_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Number of distinct input topics."""
    return A.distinct_topics(_input(spark, sf))


@register("A4", O.sql("""
  SELECT e.topic, CAST(coalesce(max(a.id), 0) AS BIGINT) AS max_id
  FROM expected_topics e LEFT JOIN articles a USING (topic) GROUP BY e.topic""",
                      "expected_topics", "articles"))
def a4_max_id(spark: SparkSession, sf: str) -> DataFrame:
    """Max id per listed topic (0 for a topic without rows): the id allocator base."""
    from topicspark.sources.store import max_ids
    m = max_ids(fx.articles(spark, sf))
    return (fx.expected_topics(spark, sf).join(m, "topic", "left")
              .select("topic", F.coalesce("max_id", F.lit(0)).cast("long").alias("max_id")))


@register("A5", O.sql("""
  SELECT "index" FROM (
    SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS "index", paragraph, topic
    FROM raw_wiki) WHERE paragraph IS NULL OR topic IS NULL""", "raw_wiki"))
def a5_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Positions (doc_id order) of paragraph rows with a null field."""
    return A.null_row_positions(fx.raw_wiki(spark, sf), ["doc_id"], ["paragraph", "topic"])


@register("A6", O.sql("SELECT topic, count(*) AS n_chunks FROM chunk_index GROUP BY topic",
                      "chunk_index"))
def a6_chunks_per_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks per topic in the chunk index."""
    return A.chunks_per_topic(_index(spark, sf)[1])


@register("A7", O.sql("""SELECT topic, CAST(sum(abs(chunkEnd - chunkStart) + 1) AS BIGINT) AS n_rows
                         FROM chunk_index GROUP BY topic""", "chunk_index"))
def a7_rows_covered(spark: SparkSession, sf: str) -> DataFrame:
    """Rows covered per topic by the chunk index."""
    return A.rows_covered(_index(spark, sf)[1])


@register("A8", O.sql("""
  SELECT a.n_chunks, a.n_rows, a.actual_topics, e.expected_topics, m.missing_topics FROM
    (SELECT count(*) AS n_chunks, CAST(coalesce(sum(abs(chunkEnd - chunkStart) + 1), 0) AS BIGINT) AS n_rows,
            count(DISTINCT topic) AS actual_topics FROM chunk_index) a,
    (SELECT count(DISTINCT topic) AS expected_topics FROM expected_topics) e,
    (SELECT count(*) AS missing_topics FROM (SELECT topic FROM expected_topics
       WHERE topic NOT IN (SELECT topic FROM chunk_index))) m""", "chunk_index", "expected_topics"))
def a8_index_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One-row summary: chunks, covered rows, actual/expected/missing topics."""
    return A.index_summary(_index(spark, sf)[1], fx.expected_topics(spark, sf))


@register("A10", O.sql("""SELECT topic, chunk, CAST(min(id) AS BIGINT) AS chunk_start,
                          CAST(max(id) AS BIGINT) AS chunk_end FROM chunked GROUP BY ALL""", "chunked"))
def a10_chunk_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """First and last id of every chunk."""
    return chunk_bounds(assign_chunks(fx.articles(spark, sf).select("topic", "id"), CHUNK))


@register("A11", O.sql("SELECT topic, chunk, summary FROM folded", "folded"))
def a11_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk text: row summaries folded in id order."""
    art = fx.articles(spark, sf)
    summ = summarize(art, ["topic", "id"])
    rows = assign_chunks(art.select("topic", "id"), CHUNK).join(summ, ["topic", "id"], "left")
    return fold_chunks(rows).select("topic", "chunk", "summary")


@register("J1", O.sql("""SELECT h.qid, h.topic, a.id, a.answer FROM hits h
                         JOIN articles a ON a.topic = h.topic AND a.id = h.row_id""", "hits", "articles"))
def j1_fetch_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Article of every top-5 hit by (topic, id)."""
    art, ci = _index(spark, sf)
    q = fx.queries(spark, sf)
    n_q = q.count()
    hits = top_hits(relevant_lines(q, summary_lines(ci), n_queries=n_q), 5)
    return fetch_articles(hits, art, bound=5 * n_q).select("qid", "topic", "id", "answer")


@register("J2", O.sql("SELECT topic FROM expected_topics WHERE topic NOT IN (SELECT topic FROM chunk_index)",
                      "expected_topics", "chunk_index"))
def j2_missing_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Expected topics without chunks (anti join)."""
    return A.missing_topics(fx.expected_topics(spark, sf), _index(spark, sf)[1])


@register("J3", O.sql("""
  SELECT e.topic, CAST(count(a.id) AS BIGINT) AS n_rows
  FROM expected_topics e LEFT JOIN articles a USING (topic) GROUP BY e.topic""",
                      "expected_topics", "articles"))
def j3_topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Every listed topic with its row count, 0 for the ghost topic."""
    return A.topic_counts(fx.expected_topics(spark, sf), fx.articles(spark, sf))


@register("J4", O.sql("""
  SELECT l.idx - 1 AS "index", l.v AS left_value, r.v AS right_value FROM
    (SELECT row_number() OVER (ORDER BY doc_id) AS idx, text AS v FROM documents) l
    JOIN (SELECT row_number() OVER (ORDER BY topic, id) AS idx, answer AS v FROM articles) r USING (idx)
  WHERE regexp_replace(l.v, '^\\s+|\\s+$', '', 'g') IS DISTINCT FROM regexp_replace(r.v, '^\\s+|\\s+$', '', 'g')
  ORDER BY l.idx LIMIT 1""", "articles"))
def j4_first_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """First position where documents (doc_id order) and articles (topic, id order) differ."""
    docs = fx.table(spark, sf, "documents").select("doc_id", F.col("text").alias("question"))
    arts = _stored(spark, sf).select("topic", "id", F.col("answer").alias("question"))
    return A.first_mismatch(docs, ["doc_id"], arts, ["id"], b_outer=["topic"])


@register("J5", O.sql("""
  SELECT qt.qid, lt.topic, lt.chunk_start, lt.chunk_end, lt.line_no, lt.term, qt.q, lt.cnt
  FROM line_terms lt JOIN q_terms qt USING (term)""", "line_terms", "q_terms"))
def j5_term_join(spark: SparkSession, sf: str) -> DataFrame:
    """Query terms x line terms: the core of scoring."""
    _, ci = _index(spark, sf)
    lkey = ["topic", "chunk_start", "chunk_end", "line_no"]
    qt = term_counts(fx.queries(spark, sf), ["qid"], "query").withColumnRenamed("cnt", "q")
    # Dealt out by line before its words are rows: their counts then need no shuffle.
    lines = summary_lines(ci).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *lkey)
    lt = term_counts(lines, lkey, "row_text")
    return lt.join(bounded_broadcast(qt), "term").select("qid", *lkey, "term", "q", "cnt")


@register("W1", O.sql("SELECT topic, id, chunk FROM chunked", "chunked"))
def w1_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk of every article: 10 rows per chunk in id order, per topic."""
    return assign_chunks(fx.articles(spark, sf).select("topic", "id"), CHUNK)


@register("W3", O.sql("""
  SELECT topic, chunkEnd AS chunk_end, next_start FROM (
    SELECT topic, chunkStart, chunkEnd,
           lead(chunkStart) OVER (PARTITION BY topic ORDER BY chunkStart, chunkEnd) AS next_start
    FROM gapped_index) WHERE next_start IS NOT NULL AND next_start <> chunkEnd + 1""",
                      "gapped_index"))
def w3_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Continuity check on a chunk index with one chunk removed from some topics."""
    return A.chunk_gaps(_gapped(_index(spark, sf)[1]))


@register("W4", O.sql("SELECT id, topic, chunkStart FROM chunk_index", "chunk_index"))
def w4_index_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Global index ids over (topic, chunk)."""
    return _index(spark, sf)[1].select("id", "topic", "chunkStart")


@register("L1", O.sql("SELECT topic, id FROM articles ORDER BY topic, id LIMIT 10 OFFSET 20",
                      "articles"))
def l1_page(spark: SparkSession, sf: str) -> DataFrame:
    """Page 2 (0-based) of 10 rows of the article table in (topic, id) order."""
    return A.page(_stored(spark, sf).select("topic", "id"), 2, 10, ["topic", "id"])


@register("L3", O.sql("""SELECT id, topic, chunkStart, strftime(updatedAt, '%Y-%m-%d %H:%M:%S') AS updatedAt
                         FROM chunk_index ORDER BY updatedAt DESC, id DESC LIMIT 3""", "chunk_index"))
def l3_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Three most recently updated chunks."""
    r = A.most_recent_chunks(_index(spark, sf)[1], 3)
    return r.select("id", "topic", "chunkStart", F.date_format("updatedAt", TS).alias("updatedAt"))


@register("L5", O.sql("""
  SELECT topic, chunk, id, CASE WHEN h <= 2 THEN 'head' ELSE 'tail' END AS part FROM (
    SELECT topic, chunk, id,
           row_number() OVER (PARTITION BY topic, chunk ORDER BY id) AS h,
           row_number() OVER (PARTITION BY topic, chunk ORDER BY id DESC) AS t
    FROM chunked) WHERE h <= 2 OR t <= 2""", "chunked"))
def l5_head_tail(spark: SparkSession, sf: str) -> DataFrame:
    """First and last 2 rows of every chunk."""
    rows = assign_chunks(fx.articles(spark, sf).select("topic", "id"), CHUNK)
    return A.chunk_head_tail(rows, 2, ["topic", "chunk"]).select("topic", "chunk", "id", "part")


@register("X1", O.sql("SELECT DISTINCT topic FROM input", "input"))
def x1_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct input topics."""
    return A.distinct_topic_rows(_input(spark, sf))


@register("X2", O.sql("SELECT topic FROM expected_topics EXCEPT SELECT topic FROM chunk_index",
                      "expected_topics", "chunk_index"))
def x2_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Expected topics minus topics present in the chunk index."""
    return A.topics_difference(fx.expected_topics(spark, sf), _index(spark, sf)[1])


@register("L4", O.sql("""
  SELECT topic, CAST(row_number() OVER (ORDER BY pairs DESC, topic) AS BIGINT) AS position, n_rows FROM (
    SELECT topic, list(struct_pack(s := chunkStart, e := chunkEnd) ORDER BY chunkStart, chunkEnd) AS pairs,
           CAST(sum(abs(chunkEnd - chunkStart) + 1) AS BIGINT) AS n_rows
    FROM gapped_index GROUP BY topic)""", "gapped_index"))
def l4_topics_by_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Topics of the gapped chunk index ordered by their chunk-range lists, descending."""
    return A.topics_by_ranges(_gapped(_index(spark, sf)[1]))
