"""Registered queries: scalar functions and the keyword family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark import oracle as O
from topicspark.functions import text as X
from topicspark.operators.chunks import summary_lines
from topicspark.operators.keywords import PROMPT_HEAD, PROMPT_TAIL, chunk_prompts, keyphrases, keyword_index, keyword_maps
from topicspark.operators.summarize import summarize
from topicspark.plans.index import plan_keyword_index
from topicspark.plans.q_ingest import _input
from topicspark.plans.q_search import CHUNK, _index
from topicspark.registry import register
from topicspark.sources import fixtures as fx

TS = "yyyy-MM-dd HH:mm:ss"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _sql_text(s: str) -> str:
    """A Python text constant as a DuckDB string expression."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


@register("F1", O.sql("SELECT conv_id, turn, coalesce(question, '') || chr(10) || coalesce(answer, '') AS text "
                      "FROM input", "input"))
def f1_qa_text(spark: SparkSession, sf: str) -> DataFrame:
    """Question + newline + answer of every input row."""
    return _input(spark, sf).select("conv_id", "turn", X.qa_text("question", "answer").alias("text"))


@register("F2", O.sql("""
  SELECT qid, len(parts) AS n_parts, array_to_string(parts, '|') AS parts FROM (
    SELECT item_id AS qid,
           CASE WHEN text = '' THEN []::VARCHAR[]
                WHEN string_split(text, ',')[-1] = ''
                  THEN list_slice(string_split(text, ','), 1, len(string_split(text, ',')) - 1)
                ELSE string_split(text, ',') END AS parts
    FROM benchmark)"""))
def f2_split_getline(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts split on ',' with getline rules."""
    p = X.split_getline(F.col("text"), ",")
    return fx.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("qid"), F.size(p).alias("n_parts"), F.array_join(p, "|").alias("parts"))


@register("F3", O.sql("""
  SELECT p_partkey, len(string_split(replace(p_name, ' ', ','), ',')) AS n_items,
         '{' || replace(p_name, ' ', ',') || '}' AS text_form FROM part"""))
def f3_array_value(spark: SparkSession, sf: str) -> DataFrame:
    """Part names as comma lists -> array value and its text form."""
    s = F.replace(F.col("p_name"), F.lit(" "), F.lit(","))
    arr = X.to_array_text(s)
    return fx.table(spark, sf, "part").select("p_partkey", F.size(arr).alias("n_items"),
                                              X.array_text(arr).alias("text_form"))


@register("F4", O.sql("""SELECT event_id, CAST(coalesce(TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g')
                         AS INTEGER), -1) AS BIGINT) AS v FROM events"""))
def f4_safe_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Digits of the event props cast to int, -1 when the cast fails."""
    return fx.table(spark, sf, "events").select(
        "event_id", X.safe_cast(F.regexp_replace("props", "[^0-9]", ""), "int", -1).alias("v"))


@register("F5", O.sql("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
                         CAST(try_strptime(event_type, '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS bad FROM events"""))
def f5_parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamp text parsed back (and a non-timestamp text giving null)."""
    e = _events(spark, sf)
    return e.select("event_id", F.date_format(X.parse_ts(F.date_format("ts", TS)), TS).alias("parsed"),
                    X.parse_ts("event_type").cast("string").alias("bad"))


@register("F6", O.sql("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_text "
                      "FROM events"))
def f6_format_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times truncated to the second, as text."""
    return _events(spark, sf).select("event_id", X.format_ts("ts").alias("ts_text"))


@register("F7", O.sql("""SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
                         strftime(to_timestamp(floor(epoch(ts))), '%Y-%m-%d %H:%M:%S') AS ts_text FROM events"""))
def f7_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch seconds of event times and back to timestamps."""
    e = _events(spark, sf).select("event_id", F.unix_seconds("ts").alias("epoch"))
    return e.select("event_id", "epoch", F.date_format(X.epoch_to_ts("epoch"), TS).alias("ts_text"))


@register("F8", O.sql("SELECT conv_id, turn, regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g') AS norm "
                      "FROM conversations"))
def f8_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation texts lower-cased and stripped."""
    return fx.table(spark, sf, "conversations").select("conv_id", "turn", X.normalize_line("text").alias("norm"))


@register("F10", O.sql("SELECT topic, chunk_start, line_no, row_id FROM lines", "lines"))
def f10_row_id(spark: SparkSession, sf: str) -> DataFrame:
    """Row id parsed from every summary line."""
    return summary_lines(_index(spark, sf)[1]).select("topic", "chunk_start", "line_no", "row_id")


@register("F11", O.sql("""SELECT topic, id, CAST(id AS VARCHAR) || '. '
                          || regexp_replace(summary, '[\\r\\n]', ' ', 'g') AS line FROM summaries""",
                       "summaries"))
def f11_render_line(spark: SparkSession, sf: str) -> DataFrame:
    """Rendered summary line of every article."""
    s = summarize(fx.articles(spark, sf), ["topic", "id"])
    return s.select("topic", "id", X.render_line("id", "summary").alias("line"))


@register("F12", O.sql("""
  SELECT topic, chunk, '{' || string_agg('''' || keyword || ''': [' || array_to_string(ids, ',') || ']',
                                         ', ' ORDER BY keyword) || '}' AS keyword_map
  FROM kw_index GROUP BY ALL""", "kw_index"))
def f12_keyword_map(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword map text of every chunk of the part table (by brand)."""
    return keyword_maps(keyword_index(fx.keyword_rows(spark, sf), CHUNK)).select("topic", "chunk", "keyword_map")


@register("F13", O.sql("""
  SELECT topic, chunk, to_json(map_from_entries(list(struct_pack(k := keyword, v := ids) ORDER BY keyword)))
         AS keyword_json
  FROM kw_index GROUP BY ALL""", "kw_index"))
def f13_keyword_json(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword map of every chunk as JSON."""
    return keyword_maps(keyword_index(fx.keyword_rows(spark, sf), CHUNK)).select("topic", "chunk", "keyword_json")


@register("T9_keywords", O.sql("""
  SELECT row_number() OVER (ORDER BY b.topic, b.chunk) AS id, b.lo AS chunkStart, b.hi AS chunkEnd, b.topic AS topic,
         coalesce(j.keyword_json, '{}') AS summary
  FROM (SELECT topic, chunk, CAST(min(id) AS BIGINT) AS lo, CAST(max(id) AS BIGINT) AS hi
        FROM kw_chunked GROUP BY topic, chunk) b
  LEFT JOIN (SELECT topic, chunk, to_json(map_from_entries(list(struct_pack(k := keyword, v := ids) ORDER BY keyword)))
                    AS keyword_json FROM kw_index GROUP BY ALL) j
  ON j.topic = b.topic AND j.chunk = b.chunk""", "kw_chunked", "kw_index"))
def t9_keyword_index(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk index with keyword maps for summaries."""
    return plan_keyword_index(fx.keyword_rows(spark, sf), CHUNK, fx.AS_OF).drop("updatedAt")


@register("F14", O.sql("""
  SELECT topic, chunkStart, array_to_string(list_slice(
           list_filter(string_split(summary, chr(10)), lambda x: length(trim(x)) > 10), 1, 5), chr(10))
         AS preview
  FROM chunk_index""", "chunk_index"))
def f14_preview(spark: SparkSession, sf: str) -> DataFrame:
    """First five lines of more than 10 characters of every chunk summary."""
    ci = _index(spark, sf)[1]
    return ci.select("topic", "chunkStart", F.array_join(X.summary_preview("summary"), "\n").alias("preview"))


@register("F15", O.sql("""SELECT source, format('{:,}', CAST(sum(n_chars) AS BIGINT)) AS chars
                          FROM documents GROUP BY source"""))
def f15_thousands(spark: SparkSession, sf: str) -> DataFrame:
    """Characters per source with thousands separators."""
    d = fx.table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("n"))
    return d.select("source", X.thousands("n").alias("chars"))


@register("F16", O.sql("SELECT topic, CAST(ceil(count(*) / 10) AS BIGINT) AS n_chunks FROM articles GROUP BY topic",
                       "articles"))
def f16_reported_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of 10 rows needed per topic."""
    a = fx.articles(spark, sf).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return a.select("topic", X.reported_chunks("n", CHUNK).alias("n_chunks"))


@register("A9", O.sql("SELECT topic, chunk, keyword, array_to_string(ids, ',') AS ids FROM kw_index",
                      "kw_index"))
def a9_keyword_index(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword -> sorted row ids per chunk of the part table (by brand)."""
    k = keyword_index(fx.keyword_rows(spark, sf), CHUNK)
    return k.select("topic", "chunk", "keyword",
                    F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


O.cte("t7_toks", f"""
  SELECT topic, id, unnest(range(len(t))) AS p, unnest(t) AS tok
  FROM (SELECT topic, id, regexp_extract_all(lower(answer), {O.TOK}) AS t FROM articles)""", ["articles"])
O.cte("t7_scored", """
  SELECT tf.topic, tf.id, tf.phrase, tf.tf * (ln((1 + n.n) / (1 + d.df)) + 1) AS score
  FROM (SELECT topic, id, phrase, count(*) AS tf FROM (
          SELECT topic, id, tok AS phrase FROM t7_toks
          UNION ALL
          SELECT a.topic, a.id, a.tok || ' ' || b.tok FROM t7_toks a
          JOIN t7_toks b ON a.topic = b.topic AND a.id = b.id AND b.p = a.p + 1)
        GROUP BY ALL) tf
  JOIN (SELECT phrase, count(*) AS df FROM (SELECT DISTINCT topic, id, phrase FROM (
          SELECT topic, id, tok AS phrase FROM t7_toks
          UNION ALL
          SELECT a.topic, a.id, a.tok || ' ' || b.tok FROM t7_toks a
          JOIN t7_toks b ON a.topic = b.topic AND a.id = b.id AND b.p = a.p + 1)) GROUP BY phrase) d
    USING (phrase)
  CROSS JOIN (SELECT count(*) AS n FROM articles) n""", ["t7_toks", "articles"])


@register("T7", O.sql("""
  SELECT topic, id, rank, phrase, round(score, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY topic, id ORDER BY round(score, 9) DESC, phrase) AS rank
    FROM t7_scored) WHERE rank <= 5""", "t7_scored"))
def t7_keyphrases(spark: SparkSession, sf: str) -> DataFrame:
    """Top-5 one- and two-word keyphrases of every article by corpus TF-IDF."""
    return keyphrases(fx.articles(spark, sf), ["topic", "id"], "answer", 5)


@register("T8", O.sql(f"""
  SELECT topic, chunk, {_sql_text(PROMPT_HEAD)} || '10' || {_sql_text(PROMPT_TAIL)}
         || string_agg(CAST(a.id AS VARCHAR) || ' ' || a.answer || ' ' || a.question || ' '
                       || 'kw1 kw2 kw3 kw4 kw5 ' || ' ' || '1704067200' || chr(10), '' ORDER BY a.id) AS prompt
  FROM chunked c JOIN articles a USING (topic, id) GROUP BY ALL""", "chunked", "articles"))
def t8_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Summary prompt text of every chunk (10 rows) for offline batch inference."""
    return chunk_prompts(fx.articles(spark, sf), CHUNK)
