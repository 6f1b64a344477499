"""DuckDB twins of the registered queries (the correctness oracle).

Each twin is written from the operator definitions, against the same test
tables, as named CTEs; ``sql(final, *ctes)`` assembles a statement with the
CTEs it needs (dependencies first).
"""

from __future__ import annotations

import math

C2 = repr((math.log(1.5) + 1.0) ** 2)
TOK = r"'[\p{L}\p{N}_]{2,}'"
NL = "chr(10)"

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTES[name] = (body, deps or [])


def sql(final: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + final


# --- fixtures ---------------------------------------------------------------
cte("articles", """
  SELECT source AS topic,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS id,
         '' AS question, text AS answer
  FROM documents""")

cte("raw_qna", f"""
  SELECT u.text AS Question, a.text AS Answer,
         'Topic ' || CAST(u.conv_id % 10 AS VARCHAR) AS Category,
         u.conv_id AS conv_id, a.turn AS turn
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'""")

cte("raw_wiki", """
  SELECT d.text AS paragraph,
         CASE WHEN l.quality IS NOT NULL THEN 'quality ' || CAST(l.quality AS VARCHAR) END AS topic,
         d.doc_id AS doc_id
  FROM documents d LEFT JOIN labels l USING (doc_id)""")

cte("expected_topics", """
  SELECT DISTINCT topic FROM (SELECT source AS topic FROM documents UNION ALL SELECT 'ghost')""")

cte("keyword_rows", """
  SELECT p_brand AS topic, p_partkey AS id, string_split(p_type, ' ') AS keywords FROM part""")

# --- T6 summaries (degree centrality) ----------------------------------------
cte("t6_base", f"""
  SELECT topic, id, coalesce(question, '') || {NL} || coalesce(answer, '') AS text FROM articles""",
    ["articles"])
cte("t6_sents", f"""
  SELECT topic, id, pos, trim(sentence) AS sentence FROM (
    SELECT topic, id, unnest(range(len(parts))) AS pos, unnest(parts) AS sentence FROM (
      SELECT topic, id,
             string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || {NL}, 'g'), {NL}) AS parts
      FROM t6_base))
  WHERE trim(sentence) <> ''""", ["t6_base"])
cte("t6_terms", f"""
  SELECT topic, id, pos, term, count(*) AS tf FROM (
    SELECT topic, id, pos, unnest(regexp_extract_all(lower(sentence), {TOK})) AS term FROM t6_sents)
  GROUP BY ALL""", ["t6_sents"])
cte("t6_n", "SELECT topic, id, count(*) AS n FROM t6_sents GROUP BY ALL", ["t6_sents"])
cte("t6_df", "SELECT topic, id, term, count(*) AS df FROM t6_terms GROUP BY ALL", ["t6_terms"])
cte("t6_w", """
  SELECT t.topic, t.id, t.pos, t.term,
         t.tf * (ln((1 + n.n) / (1 + d.df)) + 1) AS w
  FROM t6_terms t JOIN t6_df d USING (topic, id, term) JOIN t6_n n USING (topic, id)""",
    ["t6_terms", "t6_df", "t6_n"])
cte("t6_v", """
  SELECT w.topic, w.id, w.pos, w.term, w.w / nr.norm AS w
  FROM t6_w w JOIN (SELECT topic, id, pos, sqrt(sum(w * w)) AS norm FROM t6_w GROUP BY ALL) nr
    USING (topic, id, pos)""", ["t6_w"])
cte("t6_score", """
  SELECT v.topic, v.id, v.pos, sum(v.w * t.tw) AS score
  FROM t6_v v JOIN (SELECT topic, id, term, sum(w) AS tw FROM t6_v GROUP BY ALL) t
    USING (topic, id, term)
  GROUP BY ALL""", ["t6_v"])
cte("summaries", """
  SELECT a.topic, a.id, coalesce(p.summary, '') AS summary
  FROM articles a LEFT JOIN (
    SELECT topic, id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM (
      SELECT s.topic, s.id, s.pos, s.sentence,
             row_number() OVER (PARTITION BY s.topic, s.id
                                ORDER BY round(coalesce(c.score, 0.0), 9) DESC, s.pos) AS rk
      FROM t6_sents s LEFT JOIN t6_score c USING (topic, id, pos))
    WHERE rk <= 3 GROUP BY ALL) p USING (topic, id)""", ["articles", "t6_sents", "t6_score"])

# --- chunk index (W1, A10, A11, W4, T9) --------------------------------------
cte("chunked", """
  SELECT topic, id,
         CAST((row_number() OVER (PARTITION BY topic ORDER BY id) - 1) // 10 AS BIGINT) AS chunk
  FROM articles""", ["articles"])
cte("folded", f"""
  SELECT topic, chunk, CAST(min(id) AS BIGINT) AS chunk_start, CAST(max(id) AS BIGINT) AS chunk_end,
         '''' || string_agg({NL} || CAST(id AS VARCHAR) || '. '
                             || regexp_replace(coalesce(summary, ''), '[\\r\\n]', ' ', 'g') || {NL},
                             '' ORDER BY id) || '''' AS summary
  FROM (SELECT c.topic, c.chunk, c.id, s.summary FROM chunked c LEFT JOIN summaries s USING (topic, id))
  GROUP BY ALL""", ["chunked", "summaries"])
cte("chunk_index", """
  SELECT CAST(o.off + f.chunk + 1 AS BIGINT) AS id, f.chunk_start AS chunkStart,
         f.chunk_end AS chunkEnd, f.topic, f.summary,
         TIMESTAMP '2024-01-01 00:00:00' AS updatedAt
  FROM folded f JOIN (
    SELECT topic, coalesce(sum(n) OVER (ORDER BY topic ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0) AS off
    FROM (SELECT topic, count(*) AS n FROM folded GROUP BY topic)) o USING (topic)""",
    ["folded"])

# --- search (F9, F10, T1-T5) --------------------------------------------------
cte("lines", f"""
  SELECT topic, chunk_start, chunk_end, line_no, row_text,
         TRY_CAST(split_part(row_text, '.', 1) AS INTEGER) AS row_id
  FROM (
    SELECT topic, chunk_start, chunk_end, line_no,
           regexp_replace(lower(raw), '^\\s+|\\s+$', '', 'g') AS row_text
    FROM (
      SELECT topic, chunkStart AS chunk_start, chunkEnd AS chunk_end,
             unnest(range(len(parts))) AS line_no, unnest(parts) AS raw
      FROM (SELECT *, string_split(summary, {NL}) AS parts FROM chunk_index)))
  WHERE length(row_text) > 5""", ["chunk_index"])
cte("q_terms", f"""
  SELECT qid, term, count(*) AS q FROM (
    SELECT item_id AS qid, unnest(regexp_extract_all(lower(text), {TOK})) AS term FROM benchmark)
  GROUP BY ALL""")
cte("line_terms", f"""
  SELECT topic, chunk_start, chunk_end, line_no, term, count(*) AS cnt FROM (
    SELECT topic, chunk_start, chunk_end, line_no,
           unnest(regexp_extract_all(lower(row_text), {TOK})) AS term FROM lines)
  GROUP BY ALL""", ["lines"])
cte("scored", f"""
  SELECT p.qid, p.topic, p.chunk_start, p.chunk_end, p.line_no,
         p.dot / (sqrt(p.sq + {C2} * (q2.Q2 - p.sq)) * sqrt(p.sd + {C2} * (d2.D2 - p.sd))) AS score
  FROM (
    SELECT qt.qid, lt.topic, lt.chunk_start, lt.chunk_end, lt.line_no,
           sum(qt.q * lt.cnt) AS dot, sum(qt.q * qt.q) AS sq, sum(lt.cnt * lt.cnt) AS sd
    FROM line_terms lt JOIN q_terms qt USING (term) GROUP BY ALL) p
  JOIN (SELECT qid, sum(q * q) AS Q2 FROM q_terms GROUP BY qid) q2 USING (qid)
  JOIN (SELECT topic, chunk_start, chunk_end, line_no, sum(cnt * cnt) AS D2
        FROM line_terms GROUP BY ALL) d2 USING (topic, chunk_start, chunk_end, line_no)""",
    ["q_terms", "line_terms"])
cte("relevant", """
  SELECT s.qid, s.score, l.row_text, l.row_id, s.chunk_start, s.chunk_end, s.topic, s.line_no
  FROM scored s JOIN lines l USING (topic, chunk_start, chunk_end, line_no)
  WHERE s.score > 0.5""", ["scored", "lines"])
cte("hits", """
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, topic,
                                 chunk_start, line_no) AS rank
    FROM relevant) WHERE rank <= 5""", ["relevant"])

# --- input, ingest, audits ----------------------------------------------------
cte("input", """
  SELECT Question AS question, Answer AS answer, replace(Category, ' ', '-') AS topic,
         conv_id, turn
  FROM raw_qna WHERE Category IS NOT NULL""", ["raw_qna"])
cte("ingested", """
  SELECT topic, CAST(row_number() OVER (PARTITION BY topic ORDER BY conv_id, turn) AS BIGINT) AS id,
         coalesce(question, '') AS question, coalesce(answer, '') AS answer, conv_id, turn
  FROM input""", ["input"])
cte("wiki_input", """
  SELECT '' AS question, paragraph AS answer, topic, doc_id FROM raw_wiki""", ["raw_wiki"])
cte("wiki_validated", """
  SELECT *, CASE WHEN question IS NULL AND answer IS NULL AND topic IS NULL THEN 'empty row'
                 WHEN topic IS NULL THEN 'missing topic column'
                 WHEN trim(topic) = '' THEN 'empty topic' END AS reject_reason
  FROM wiki_input""", ["wiki_input"])
cte("gapped_index", """
  SELECT c.* FROM chunk_index c JOIN (
    SELECT topic, row_number() OVER (ORDER BY topic) AS tpos FROM (SELECT DISTINCT topic FROM chunk_index)) t
    USING (topic)
  WHERE c.chunkStart <> t.tpos * 10 + 1""",
    ["chunk_index"])
cte("kw_chunked", """
  SELECT topic, id, keywords,
         CAST((row_number() OVER (PARTITION BY topic ORDER BY id) - 1) // 10 AS BIGINT) AS chunk
  FROM keyword_rows""", ["keyword_rows"])
cte("kw_index", """
  SELECT topic, chunk, keyword, list_sort(list(CAST(id AS BIGINT))) AS ids FROM (
    SELECT topic, chunk, id, unnest(keywords) AS keyword FROM kw_chunked)
  GROUP BY ALL""", ["kw_chunked"])
