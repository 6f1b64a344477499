"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import (
    balanced_shards, block_topk, bpe_prefix, chat_format, filter_audit, host_rules, jaccard_join, line_dedup, prefix_trie,
    rule_ensemble, secret_scan, seed_extend, soft_mixing,
)
from llm.tables import ship, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def put(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return put


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.v, v.v) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@_register("op1_block_topk", TOPK_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = block_topk.integers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return block_topk.search(vectors, vectors.filter("vec_id % 50 = 0"), 5)


@_register("op2_rule_ensemble_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register("op3_soft_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mixing.mixer(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).rates()


@_register("op4_seed_extend_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.dedup_substrings(table(spark, sf_dir, "documents"))


@_register("op5_host_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def vocabulary() -> str:
    """The public vocabulary file that the queries use, as text."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@_register("op6_prefix_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_prefix.encode_documents(table(spark, sf_dir, "documents"), vocabulary())


@_register("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


@_register("op8_balanced_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards.shard_documents(table(spark, sf_dir, "documents"))


@_register("op9_ngram_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@_register("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


#: The template's lengths are those of llm/chat_format.py: marks of a turn, and a backslash for each control string in it.
CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '</?s>|\\[/?(?:INST|SYS|ROLE)\\]|\\[TEXT\\]'))
       + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 13
         ELSE 23 + length(role) + len(regexp_extract_all(role, '</?s>|\\[/?(?:INST|SYS|ROLE)\\]|\\[TEXT\\]')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


@_register("op11_chat_format", CHAT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.conflict(spark, table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.read_back(chat_format.format_conversations(rows)))


TRIE_SQL = """
WITH RECURSIVE crc AS (
  SELECT conv_id, conv_id::VARCHAR AS digits, 0 AS bit, 4294967295::BIGINT AS v
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT conv_id, digits, bit + 1, xor(w >> 1, CASE WHEN w % 2 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT *, CASE WHEN bit % 8 = 0 THEN xor(v, ascii(substr(digits, bit // 8 + 1, 1))::BIGINT) ELSE v END AS w FROM crc)
  WHERE bit < 8 * length(digits)),
h AS (SELECT conv_id, xor(v, 4294967295) % 6 AS h FROM crc WHERE bit = 8 * length(digits)),
t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (
  SELECT h.conv_id, 0 AS own, pos, id, chars FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 100 WHERE pos <= h
  UNION ALL SELECT conv_id, 1, pos, id, chars FROM h JOIN t USING (conv_id) WHERE pos > h),
p AS (SELECT conv_id, list(id ORDER BY own, pos) AS path, list(chars ORDER BY own, pos) AS lens FROM r GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(path, []) AS path, coalesce(lens, []) AS lens FROM h LEFT JOIN p USING (conv_id)),
m AS (
  SELECT conv_id, path, lens, unnest(range(0, len(path) + 1)) AS depth FROM c),
n AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(max(lens[depth]), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL),
k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
nk AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (
  SELECT node[1:d] AS node, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM nk) GROUP BY 1)
SELECT nk.conv_id, nk.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, nk.n_convs, nk.n_children, n_leaves, saved_tokens,
       nk.ends_sha256
FROM nk JOIN s USING (node) LEFT JOIN n AS up ON nk.depth > 0 AND up.node = nk.node[1:nk.depth - 1]
"""


@_register("op12_prefix_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


FILTER_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
m AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN min(w.doc_id) OVER (PARTITION BY text) < w.doc_id THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN m USING (doc_id)),
g AS (SELECT part, fails, good, toxic, count(*) AS n FROM d GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS failed,
         translate(fails, earlier, '') <> fails AS gone FROM g, s),
t AS (
  SELECT part, filter_order, step, x,
         sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN failed AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = x THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN failed AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN failed AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM t
"""


@_register("op13_filter_audit", FILTER_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
