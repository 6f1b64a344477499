"""Registered queries: sources, clean-up, validation, ingest (S, P, W2, A12, X3, ST1, Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark import oracle as O
from topicspark.operators import prepare as P
from topicspark.operators.audit import append_batches
from topicspark.plans.ingest import ingest, load_report
from topicspark.plans.preprocess import preprocess_qna
from topicspark.plans.sql import generated_table, topic_sql
from topicspark.registry import register
from topicspark.session import scratch_path
from topicspark.sources import csv_io, store
from topicspark.sources import fixtures as fx
from topicspark.streaming import ingest as stream

TS = "yyyy-MM-dd HH:mm:ss"


def _input(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned input rows with their input order (conv_id, turn)."""
    raw = fx.raw_qna(spark, sf)
    return P.slug_topic(P.drop_null_topic(raw.select(
        F.col("Question").alias("question"), F.col("Answer").alias("answer"),
        F.col("Category").alias("topic"), "conv_id", "turn")))


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The article table as it is stored: topic partitions, files sorted by id."""
    path = scratch_path(spark, "articles")
    store.append_articles(fx.articles(spark, sf), path, mode="overwrite")
    return store.read_articles(spark, path)


def _wiki_input(spark: SparkSession, sf: str) -> DataFrame:
    return fx.raw_wiki(spark, sf).select(F.lit("").alias("question"),
                                         F.col("paragraph").alias("answer"), "topic", "doc_id")


@register("S1", O.sql("SELECT question, answer, topic FROM input", "input"))
def s1_read_input_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned input written as headerless CSV (S6), read back whole."""
    path = scratch_path(spark, "s1")
    csv_io.write_input_csv(_input(spark, sf), path)
    return csv_io.read_input_csv(spark, path)


@register("S2", O.sql("""SELECT Question, Answer, Category, CAST(conv_id AS VARCHAR) AS conv_id,
                         CAST(turn AS VARCHAR) AS turn FROM raw_qna""", "raw_qna"))
def s2_read_headed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The raw Q&A table as CSV with header, read back with every column a string."""
    path = scratch_path(spark, "s2")
    (fx.raw_qna(spark, sf).write.mode("overwrite").option("header", True)
       .option("quote", '"').option("escape", '"').csv(path))
    return csv_io.read_headed_csv(spark, path)


@register("S3", O.sql("SELECT Question AS question, Answer AS answer, Category AS topic FROM raw_qna",
                      "raw_qna"))
def s3_projected_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Headed CSV scan projected to Question, Answer, Category and renamed."""
    path = scratch_path(spark, "s3")
    (fx.raw_qna(spark, sf).write.mode("overwrite").option("header", True)
       .option("quote", '"').option("escape", '"').csv(path))
    return P.rename_qna(csv_io.read_headed_csv(spark, path, ["Question", "Answer", "Category"]))


@register("S4", O.sql("SELECT topic FROM expected_topics", "expected_topics"))
def s4_read_topics(spark: SparkSession, sf: str) -> DataFrame:
    """The expected topic list written as text and read back (stripped)."""
    path = scratch_path(spark, "s4")
    fx.expected_topics(spark, sf).select(F.concat(F.lit("  "), "topic", F.lit(" ")).alias("topic")) \
        .write.mode("overwrite").text(path)
    return csv_io.read_topics(spark, path)


@register("S5", O.sql("SELECT DISTINCT topic FROM input", "input"))
def s5_write_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct input topics written one per line (S5), read back."""
    path = scratch_path(spark, "s5")
    csv_io.write_topics(_input(spark, sf), path)
    return csv_io.read_topics(spark, path)


@register("S6", O.sql("SELECT '' AS question, paragraph AS answer, replace(topic, ' ', '-') AS topic "
                      "FROM raw_wiki WHERE topic IS NOT NULL", "raw_wiki"))
def s6_write_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraph input cleaned (P2-P4), written headerless (S6), read back."""
    path = scratch_path(spark, "s6")
    csv_io.write_input_csv(P.clean_paragraphs(fx.raw_wiki(spark, sf)), path)
    return csv_io.read_input_csv(spark, path)


@register("preprocess", O.sql("""
  SELECT 'row' AS kind, coalesce(Question, '') AS question, coalesce(Answer, '') AS answer,
         replace(Category, ' ', '-') AS topic FROM raw_qna WHERE Category IS NOT NULL
  UNION ALL
  SELECT DISTINCT 'topic', '', '', replace(Category, ' ', '-') FROM raw_qna WHERE Category IS NOT NULL""", "raw_qna"))
def preprocess(spark: SparkSession, sf: str) -> DataFrame:
    """A raw headed CSV preprocessed: its cleaned rows and its topic list, read back."""
    raw, rows, topics = (scratch_path(spark, f"preprocess-{k}") for k in ("raw", "rows", "topics"))
    (fx.raw_qna(spark, sf).select("Question", "Answer", "Category").write
       .option("header", True).option("quote", '"').option("escape", '"').csv(raw))
    preprocess_qna(spark, raw, rows, topics)
    empty = F.lit("")
    return (csv_io.read_input_csv(spark, rows).select(F.lit("row").alias("kind"), "question", "answer", "topic")
            .unionByName(csv_io.read_topics(spark, topics).select(
                F.lit("topic").alias("kind"), empty.alias("question"), empty.alias("answer"), "topic")))


@register("S7", O.sql("SELECT question, answer, topic FROM input", "input"))
def s7_export_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Every topic exported to its own headed CSV folder, read back."""
    path = scratch_path(spark, "s7")
    csv_io.export_topics_csv(_input(spark, sf).select("question", "answer", "topic"), path)
    back = csv_io.read_headed_csv(spark, path)
    return back.select(F.coalesce("question", F.lit("")).alias("question"),
                       F.coalesce("answer", F.lit("")).alias("answer"),
                       F.col("topic").cast("string").alias("topic"))


#: Two loads: the conversations of even numbers, then the others.
_LOADED = """(SELECT topic, question, answer, conv_id, turn,
         row_number() OVER (PARTITION BY topic ORDER BY conv_id % 2, conv_id, turn) AS id FROM ingested)"""
_S8_SQL = O.sql(f"""
  SELECT topic, id, question, answer, '{{kw1,kw2,kw3,kw4,kw5}}' AS keywords,
         '2024-01-01 00:00:00' AS updatedAt FROM {_LOADED}""", "ingested")


@register("S8", _S8_SQL)
def s8_routed_append(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned input loaded in two loads (P9, P12, W2, id log) and appended to the topic-partitioned table."""
    path = scratch_path(spark, "s8")
    for part in (0, 1):
        ingest(_input(spark, sf).filter(f"conv_id % 2 = {part}"), path, fx.AS_OF, ["conv_id", "turn"])
    back = store.read_articles(spark, path)
    return back.select("topic", "id", "question", "answer",
                       F.concat(F.lit("{"), F.array_join("keywords", ","), F.lit("}")).alias("keywords"),
                       F.date_format("updatedAt", TS).alias("updatedAt"))


@register("S9", O.sql("""
  SELECT topic, id, answer FROM articles
  WHERE topic = (SELECT topic FROM articles GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 1)""",
                      "articles"))
def s9_scan_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Scan of one topic's table (the largest topic), partition-pruned."""
    path = scratch_path(spark, "s9")
    store.append_articles(fx.articles(spark, sf), path, mode="overwrite")
    arts = store.read_articles(spark, path)
    top = (arts.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "topic").first()["topic"])
    return store.scan_topic(spark, path, top).select("topic", "id", "answer")


@register("S12", O.sql("""
  SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
         CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice,
         'manual' AS topic FROM part"""))
def s12_manual_insert(spark: SparkSession, sf: str) -> DataFrame:
    """A headed CSV (part) inserted as all-string rows of the named topic 'manual'."""
    src, dst = scratch_path(spark, "s12-in"), scratch_path(spark, "s12-tbl")
    fx.table(spark, sf, "part").write.mode("overwrite").option("header", True).csv(src)
    csv_io.manual_insert(spark, src, "manual").write.mode("append").partitionBy("topic").parquet(dst)
    return spark.read.parquet(dst).select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                          "p_retailprice", F.col("topic").cast("string"))


@register("P1", O.sql("SELECT Question AS question, Answer AS answer, Category AS topic FROM raw_qna",
                      "raw_qna"))
def p1_rename(spark: SparkSession, sf: str) -> DataFrame:
    """Select and rename Question/Answer/Category."""
    return P.rename_qna(fx.raw_qna(spark, sf))


@register("P2", O.sql("SELECT doc_id, topic FROM raw_wiki WHERE topic IS NOT NULL", "raw_wiki"))
def p2_drop_null_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraph rows without a topic dropped."""
    return P.drop_null_topic(fx.raw_wiki(spark, sf)).select("doc_id", "topic")


@register("P3", O.sql("SELECT conv_id, turn, topic FROM input", "input"))
def p3_slug(spark: SparkSession, sf: str) -> DataFrame:
    """Topic slug: spaces to dashes."""
    return _input(spark, sf).select("conv_id", "turn", "topic")


@register("P4", O.sql("SELECT doc_id, '' AS question, paragraph AS answer, topic FROM raw_wiki",
                      "raw_wiki"))
def p4_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraph rows as (question = '', answer, topic)."""
    return P.paragraphs_to_input(fx.raw_wiki(spark, sf), keep=["doc_id"])


@register("P5", O.sql("SELECT conv_id, turn, question, topic FROM input WHERE topic = 'Topic-3'",
                      "input"))
def p5_topic_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of topic 'Topic-3'."""
    return P.topic_filter(_input(spark, sf), "Topic-3").select("conv_id", "turn", "question", "topic")


@register("P6", O.sql("SELECT topic, id FROM articles WHERE id BETWEEN 11 AND 20", "articles"))
def p6_id_range(spark: SparkSession, sf: str) -> DataFrame:
    """get_chunk(11, 20) on every topic table."""
    return P.id_range(_stored(spark, sf), 11, 20).select("topic", "id")


@register("P7", O.sql("SELECT topic, id, answer FROM articles WHERE topic = 'src1' AND id = 7",
                      "articles"))
def p7_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Point lookup (src1, 7)."""
    return P.point_lookup(_stored(spark, sf), "src1", 7).select("topic", "id", "answer")


@register("P8", O.sql("SELECT question, answer, topic FROM input", "input"))
def p8_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Classification: topic taken from the third input column."""
    return P.classify(_input(spark, sf).select("question", "answer", "topic"))


@register("P9", O.sql("""
  SELECT CASE WHEN topic IS NULL AND doc_id % 3 = 2 THEN NULL ELSE doc_id END AS doc_id,
         CASE WHEN topic IS NOT NULL THEN NULL WHEN doc_id % 3 = 0 THEN 'missing topic column'
              WHEN doc_id % 3 = 1 THEN 'empty topic' ELSE 'empty row' END AS reject_reason
  FROM raw_wiki""", "raw_wiki"))
def p9_validate(spark: SparkSession, sf: str) -> DataFrame:
    """Validation of the paragraphs as raw CSV records: unlabelled ones are
    written as short rows, with a blank topic, or as blank lines."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    two = F.concat(quoted("doc_id"), F.lit(","), quoted("paragraph"))
    line = (F.when(F.col("topic").isNotNull(), F.concat(two, F.lit(","), quoted("topic")))
             .when(F.col("doc_id") % 3 == 0, two).when(F.col("doc_id") % 3 == 1, F.concat(two, F.lit(',"  \t"')))
             .otherwise(F.lit(" ")))
    path = scratch_path(spark, "p9")
    fx.raw_wiki(spark, sf).select(line.alias("value")).write.text(path)
    rows = P.validate(csv_io.read_input_csv(spark, path, with_place=True))
    return rows.select(F.col("question").try_cast("long").alias("doc_id"), "reject_reason")


@register("P10", O.sql("SELECT topic, id, '{kw1,kw2,kw3,kw4,kw5}' AS keywords FROM articles",
                       "articles"))
def p10_placeholder_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Placeholder keywords on every article."""
    a = fx.articles(spark, sf)
    return a.select("topic", "id", F.concat(F.lit("{"), F.array_join(P.placeholder_keywords(), ","),
                                            F.lit("}")).alias("keywords"))


@register("P11", O.sql("""
  SELECT CAST(ordinal_position AS BIGINT) AS ordinal, column_name AS name,
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
              WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE lower(data_type) END AS type
  FROM information_schema.columns WHERE table_name = 'documents'"""))
def p11_column_names(spark: SparkSession, sf: str) -> DataFrame:
    """Column names and types of the documents table in ordinal order."""
    return P.column_names(fx.table(spark, sf, "documents"))


@register("P12", O.sql("""
  SELECT topic, coalesce(question, '') AS question, coalesce(answer, '') AS answer,
         '{kw1,kw2,kw3,kw4,kw5}' AS keywords, '2024-01-01 00:00:00' AS updatedAt, conv_id, turn
  FROM input""", "input"))
def p12_node_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Input rows reshaped to node rows (keywords, load time)."""
    n = P.to_node_rows(_input(spark, sf), fx.AS_OF)
    return n.select("topic", "question", "answer",
                    F.concat(F.lit("{"), F.array_join("keywords", ","), F.lit("}")).alias("keywords"),
                    F.date_format("updatedAt", TS).alias("updatedAt"), "conv_id", "turn")


@register("P13", O.sql("SELECT doc_id, (paragraph IS NULL OR topic IS NULL) AS has_null FROM raw_wiki",
                       "raw_wiki"))
def p13_any_null(spark: SparkSession, sf: str) -> DataFrame:
    """Any-null flag over (paragraph, topic)."""
    w = fx.raw_wiki(spark, sf)
    return w.select("doc_id", P.any_null(w, ["paragraph", "topic"]).alias("has_null"))


@register("P14", O.sql("""SELECT conv_id, turn,
  CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS "index" FROM input""", "input"))
def p14_row_index(spark: SparkSession, sf: str) -> DataFrame:
    """0-based row index of the input in input order."""
    return P.with_row_index(_input(spark, sf).select("conv_id", "turn"), ["conv_id", "turn"])


@register("W2", O.sql(f"SELECT topic, id, conv_id, turn FROM {_LOADED}", "ingested"))
def w2_allocate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Per-topic ids from max(id)+1 in input order: 1 upward for the first load, and on from there for the second."""
    first = store.allocate_ids(_input(spark, sf).filter("conv_id % 2 = 0"), None, ["conv_id", "turn"])
    second = store.allocate_ids(_input(spark, sf).filter("conv_id % 2 = 1"), first, ["conv_id", "turn"])
    return first.unionByName(second).select("topic", "id", "conv_id", "turn")


@register("A12", O.sql("""
  SELECT topic, count(*) AS rows, count(*) FILTER (WHERE reject_reason IS NULL) AS loaded,
         count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected
  FROM wiki_validated GROUP BY topic""", "wiki_validated"))
def a12_load_report(spark: SparkSession, sf: str) -> DataFrame:
    """Load report of the paragraph input: rows, loaded and rejected per topic."""
    return load_report(P.validate(_wiki_input(spark, sf)))


@register("X3", O.sql("""
  SELECT question, answer, topic, 'qna' AS batch FROM input
  UNION ALL SELECT '' AS question, paragraph AS answer, replace(topic, ' ', '-') AS topic, 'wiki'
  FROM raw_wiki WHERE topic IS NOT NULL""", "input", "raw_wiki"))
def x3_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two input batches appended (Q&A and paragraphs)."""
    a = _input(spark, sf).select("question", "answer", "topic", F.lit("qna").alias("batch"))
    b = P.clean_paragraphs(fx.raw_wiki(spark, sf)).withColumn("batch", F.lit("wiki"))
    return append_batches(a, b)


@register("ST1", O.sql("SELECT topic, coalesce(question, '') AS question, coalesce(answer, '') AS answer, "
                       "true AS dense FROM input UNION ALL SELECT 'missing topic column', coalesce(question, ''), NULL, true "
                       "FROM input", "input"))
def st1_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned input loaded by two ways into one table: the even conversations
    as a batch, the others as CSV files through micro-batches, with a short
    record for every row. Rows with whether their topic's ids are 1 to its
    count, and the rejects with their reason as the topic."""
    base = scratch_path(spark, "st1")
    folder, table, ckpt = stream.stream_paths(base)
    rows = _input(spark, sf)
    ingest(rows.filter("conv_id % 2 = 0"), table, fx.AS_OF, ["conv_id", "turn"])
    csv_io.write_input_csv(rows.filter("conv_id % 2 = 1").repartition(4, "topic"), folder)
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("question", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    rows.select(quoted.alias("value")).write.mode("append").text(folder)
    stream.run_ingest_stream(spark, folder, table, ckpt, fx.AS_OF, files_per_batch=4)
    got = stream.read_ingested(spark, table)
    dense = got.groupBy("topic").agg(((F.countDistinct("id") == F.count(F.lit(1))) & (F.min("id") == 1)
                                      & (F.max("id") == F.count(F.lit(1)))).alias("dense"))
    rejects = spark.read.parquet(stream.rejects_path(table)).select(
        F.col("reject_reason").alias("topic"), "question", F.lit(None).cast("string").alias("answer"), F.lit(True).alias("dense"))
    return got.join(dense, "topic").select("topic", "question", "answer", "dense").unionByName(rejects)


@register("Q1", O.sql("""
  SELECT count(*) AS n, max(id) AS max_id, sum(length(answer)) AS chars
  FROM articles WHERE topic = 'src3'""", "articles"))
def q1_topic_sql(spark: SparkSession, sf: str) -> DataFrame:
    """User SQL against the 'src3' topic table (visible as ``test``)."""
    return topic_sql(spark, _stored(spark, sf), "src3",
                     "SELECT count(*) AS n, max(id) AS max_id, sum(length(answer)) AS chars FROM test")


@register("Q2", O.sql("""
  SELECT CAST(i AS BIGINT) AS id, 'Data ' || CAST(i AS VARCHAR) AS name
  FROM range(1, (SELECT count(*) FROM documents) + 1) t(i)"""))
def q2_generated(spark: SparkSession, sf: str) -> DataFrame:
    """Generated table 'Data i', one row per document."""
    n = fx.table(spark, sf, "documents").count()
    return generated_table(spark, n)
