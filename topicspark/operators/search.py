"""TF-IDF cosine search over the chunk index.

The original scores a query against each summary line with a vectoriser
fitted on just the two texts (raw counts, smoothed IDF, L2 norm). With two
documents a term in both has IDF 1 and a term in one has c = ln(3/2) + 1, so
over the shared terms S, with counts q and d and plain sums of squares Q2
and D2:

    score = sum_S q*d / ( sqrt(sum_S q^2 + c^2 (Q2 - sum_S q^2))
                        * sqrt(sum_S d^2 + c^2 (D2 - sum_S d^2)) )

No shared term gives 0, so an inner join of line terms and query terms
loses nothing for thresholds >= 0. Query terms are a small table (bounded by
the query texts); they are broadcast when their checked size allows.

A stored index scores only candidate lines where the queries' postings are few
(see ``candidate_share`` and ``index_candidates``); a broad batch of queries is
scored by one pass over the lines, inside their tasks, from which only hits
come out. ``score_pairs`` (T1) gives the scores of all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from topicspark.functions.text import IDF_ONE_OF_TWO, tokens, value_counts
from topicspark.session import checkpoint_dir, scratch_path

MAX_BROADCAST_TERMS = 5_000_000
DEFAULT_K = 5
DEFAULT_THRESHOLD = 0.5


def term_counts(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, term, cnt) raw counts, plus (key, sq) sums of squares."""
    tc = (df.select(*key, F.explode(tokens(text)).alias("term"))
            .groupBy(*key, "term").agg(F.count(F.lit(1)).alias("cnt")))
    return tc


def _squares(tc: DataFrame, key: list[str], name: str) -> DataFrame:
    return tc.groupBy(*key).agg(F.sum(F.col("cnt") * F.col("cnt")).alias(name))


def score_pairs(queries: DataFrame, lines: DataFrame, qkey: str = "qid",
                qtext: str = "query", lkey: list[str] | None = None,
                ltext: str = "row_text", n_queries: int | None = None,
                carry: list[str] | None = None) -> DataFrame:
    """T1 over every (query, line) pair that shares a term:
    (qid, lkey..., carry..., score).

    J5 is the join of line terms with the (broadcast) query terms. Lines are
    hash-partitioned on their key once. Up to ``MAX_PUSHDOWN_TERMS`` query
    terms go to the tasks, where each line is scored against all queries; more
    are joined, and the per-line sums and the per-(query, line) aggregate
    reuse the lines' partitioning."""
    lkey = lkey or ["topic", "chunk_start", "chunk_end", "line_no"]
    carry = [c for c in (carry if carry is not None else [ltext, "row_id"]) if c in lines.columns]
    c2 = IDF_ONE_OF_TWO * IDF_ONE_OF_TWO
    qtc = term_counts(queries, [qkey], qtext)
    # An explicit partition count: the lines are small in bytes but the
    # pairs built from them are many, so the shuffle must not be coalesced
    # into a few tasks.
    n_parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartition(n_parts, *[F.col(k) for k in lkey])
    bound = min(MAX_BROADCAST_TERMS, MAX_PUSHDOWN_TERMS)
    asked = qtc.limit(bound + 1).collect() if n_queries is None or n_queries <= bound else None
    if asked is not None and len(asked) <= bound:
        return _scored_in_lines(asked, queries.schema[qkey], dealt, lkey, carry, ltext)
    qt = (qtc.withColumn("Q2", F.sum(F.col("cnt") * F.col("cnt")).over(Window.partitionBy(qkey)))
             .select(qkey, "term", F.col("cnt").alias("q"), "Q2"))
    ltc = (dealt.select(*lkey, *carry, F.explode(tokens(ltext)).alias("term"))
                .groupBy(*lkey, *carry, "term").agg(F.count(F.lit(1)).alias("cnt"))
                .withColumn("D2", F.sum(F.col("cnt") * F.col("cnt")).over(Window.partitionBy(*lkey))))
    # The query-term table has at most (terms per query) x queries rows;
    # count it when the query count allows, broadcast it when small.
    n_queries = queries.count() if n_queries is None else n_queries
    n_terms = qt.count() if n_queries <= MAX_BROADCAST_TERMS else MAX_BROADCAST_TERMS + 1
    qside = F.broadcast(qt) if n_terms <= MAX_BROADCAST_TERMS else qt
    # Per-line values ride along as first(): they are constant per group and
    # stay out of the grouping hash key.
    pairs = (ltc.join(qside, "term")
                .groupBy(qkey, *lkey)
                .agg(*[F.first(c).alias(c) for c in (*carry, "Q2", "D2")],
                     F.sum(F.col("q") * F.col("cnt")).alias("dot"),
                     F.sum(F.col("q") * F.col("q")).alias("sq"),
                     F.sum(F.col("cnt") * F.col("cnt")).alias("sd")))
    return pairs.select(qkey, *lkey, *carry,
                        (F.col("dot") / (F.sqrt(F.col("sq") + c2 * (F.col("Q2") - F.col("sq")))
                                         * F.sqrt(F.col("sd") + c2 * (F.col("D2") - F.col("sd")))))
                        .alias("score"))


#: Pairs that a task holds at a time, and that an Arrow batch of them has.
SLICE_PAIRS = 200_000


def _scored_in_lines(asked: list, qfield: StructField, lines: DataFrame, lkey: list[str], carry: list[str], ltext: str) -> DataFrame:
    """``score_pairs`` for a bounded list of query terms (qid, term, cnt):
    each line meets all queries inside its task, so that no row is made per
    shared term and no group per pair. Lines that share a key count as one."""
    whole = (lines.groupBy(*lkey).agg(*[F.first(c).alias(f"_c{i}") for i, c in enumerate(carry)],
                                      F.concat_ws(" ", F.collect_list(ltext)).alias("_text"))
                  .select(*lkey, *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], tokens("_text").alias("_tokens")))
    return _scored(asked, qfield, whole)


def _scored(asked: list, qfield: StructField, lines: DataFrame, threshold: float | None = None) -> DataFrame:
    """(qid, the columns of ``lines``, score) of lines whose last column is
    ``_tokens``: all pairs that share a term, or those above ``threshold``."""
    qids = list(dict.fromkeys(r[0] for r in asked))
    kept = lines.columns[:-1]
    out = StructType(lines.schema.fields[:-1]).add("_q", IntegerType()).add("score", DoubleType())
    names = lines.sparkSession.createDataFrame(list(enumerate(qids)), StructType().add("_q", IntegerType()).add(qfield))
    pairs = lines.mapInArrow(_pair_scores(asked, qids, threshold), out)
    return pairs.join(F.broadcast(names), "_q").select(qfield.name, *kept, "score")  # a row per query


def _lines_above(asked: list, qfield: StructField, lines: DataFrame, threshold: float) -> DataFrame:
    """(qid, line key..., row_id, row_text, score) of the lines above
    ``threshold``, from one pass over the lines: each is scored against all
    query terms (qid, term, cnt) inside its task, and only hits leave it. As
    in the stored index, lines and queries without a whole key take no part."""
    n_parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.dropna(subset=LINE_KEY).repartition(n_parts, *LINE_KEY)  # few bytes, much work
    return _scored([r for r in asked if r[0] is not None], qfield,
                   dealt.select(*LINE_KEY, "row_id", "row_text", tokens("row_text").alias("_tokens")), threshold)


def _pair_scores(asked: list, qids: list, threshold: float | None = None):
    """Arrow function: lines with their tokens -> a row for each (line, query)
    that share a term (and score above ``threshold``, if there is one). One
    nested function, for executors without this package."""
    at = {q: i for i, q in enumerate(qids)}
    postings = sorted((r[1], at[r[0]], r[2]) for r in asked)
    terms = list(dict.fromkeys(t for t, _, _ in postings))
    slice_pairs, c2 = SLICE_PAIRS, IDF_ONE_OF_TWO * IDF_ONE_OF_TWO

    def scores(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n_q, n_terms = len(qids), len(terms)
        number = {t: i for i, t in enumerate(terms)}
        of_query = np.array([q for _, q, _ in postings], np.int64)
        weight = np.array([c for _, _, c in postings], np.int64)
        held = np.bincount([number[t] for t, _, _ in postings], minlength=n_terms) if terms else np.zeros(0, np.int64)
        start = np.cumsum(held) - held
        q2 = np.bincount(of_query, weight * weight, n_q)
        vocabulary = pa.array(terms, pa.string())
        step = max(1, slice_pairs // max(n_q, 1))

        def scored(rows):
            words = rows.column("_tokens")
            size = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
            coded = words.flatten().dictionary_encode()
            kinds = max(len(coded.dictionary), 1)
            line = np.repeat(np.arange(len(rows)), size)
            entry, cnt = np.unique(line * kinds + coded.indices.to_numpy(), return_counts=True)
            line, kind = entry // kinds, entry % kinds
            d2 = np.bincount(line, cnt * cnt, len(rows))
            known = pc.index_in(coded.dictionary.cast(pa.string()), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
            term = known[kind] if len(kind) else kind
            line, cnt, term = line[term >= 0], cnt[term >= 0], term[term >= 0]
            # Each shared term once for each query that has it.
            many = held[term]
            first = np.cumsum(many) - many
            posting = np.arange(many.sum()) + np.repeat(start[term] - first, many)
            pair, cnt, q = np.repeat(line, many) * n_q + of_query[posting], np.repeat(cnt, many), weight[posting]
            dot, sq, sd = (np.bincount(pair, x, len(rows) * n_q) for x in (q * cnt, q * q, cnt * cnt))
            hit = np.flatnonzero(sq)
            dot, sq, sd, line, query = dot[hit], sq[hit], sd[hit], hit // n_q, hit % n_q
            score = dot / (np.sqrt(sq + c2 * (q2[query] - sq)) * np.sqrt(sd + c2 * (d2[line] - sd)))
            if threshold is not None:
                line, query, score = (x[score > threshold] for x in (line, query, score))
            kept = rows.select([c for c in rows.schema.names if c != "_tokens"]).take(pa.array(line))
            return pa.RecordBatch.from_arrays([*kept.columns, pa.array(query, pa.int32()), pa.array(score)],
                                              names=[*kept.schema.names, "_q", "score"])

        for batch in batches:
            for low in range(0, len(batch) if n_q else 0, step):
                yield scored(batch.slice(low, step))
    return scores


def candidate_share(threshold: float) -> float:
    """The share of a query's squared weight Q2 that the terms shared with a
    line must exceed for a score above ``threshold``.

    By Cauchy, dot^2 <= sq * sd, and the line's norm is at least sqrt(sd), so
    score^2 <= sq / (sq + c^2 (Q2 - sq)); that is above t^2 only where
    sq / Q2 > t^2 c^2 / (1 - t^2 + t^2 c^2). (A hair less than the threshold is
    taken, so that rounding of a score never costs a hit.)"""
    t2 = max(threshold - 1e-9, 0.0) ** 2
    c2 = IDF_ONE_OF_TWO * IDF_ONE_OF_TWO
    return t2 * c2 / (1 - t2 + t2 * c2)


def relevant_lines(queries: DataFrame, lines: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                   qkey: str = "qid", qtext: str = "query", n_queries: int | None = None) -> DataFrame:
    """Lines scoring strictly above ``threshold``:
    (qid, topic, chunk_start, chunk_end, line_no, row_text, row_id, score).

    Up to ``MAX_PUSHDOWN_TERMS`` query terms go to the tasks, where each line
    is scored once: an index read by one batch of queries would cost more to
    write than it saves. For more terms the lines are stored as a search index
    in the scratch folder, and candidate lines are scored (see
    ``index_candidates``)."""
    asked = term_counts(queries, [qkey], qtext).limit(MAX_PUSHDOWN_TERMS + 1).collect()
    if len(asked) <= MAX_PUSHDOWN_TERMS:
        return _lines_above(asked, queries.schema[qkey], lines, threshold).select(
            qkey, *LINE_KEY, "row_text", "row_id", "score")
    base = scratch_path(lines.sparkSession, "lines")
    store_lines(lines, base + "/terms", base + "/lines")
    found = index_candidates(queries, base + "/terms", threshold, qkey, qtext)
    return score_candidates(found, base + "/lines", threshold, qkey).select(
        qkey, *LINE_KEY, "row_text", "row_id", "score")


def top_hits(relevant: DataFrame, k: int = DEFAULT_K, qkey: str = "qid") -> DataFrame:
    """L2: the ``k`` best lines per query, ties by (topic, chunk, row id).

    ``row_number() <= k`` is planned with a partial per-task limit before the
    shuffle, so a query matching most lines still moves only k rows per task.
    """
    w = Window.partitionBy(qkey).orderBy(F.round("score", 9).desc(), "topic",
                                         "chunk_start", "line_no")
    return (relevant.withColumn("rank", F.row_number().over(w))
                    .filter(F.col("rank") <= k))


#: Literal lists of more values cost more in planning than they save in reading.
MAX_LITERALS = 200
MAX_BROADCAST_KEYS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def fetch_articles(hits: DataFrame, articles: DataFrame, bound: int | None = None) -> DataFrame:
    """Answer text of every hit by (topic, row id). Hits without an
    article drop out. ``bound`` is an upper bound on the hit count (k x
    queries).

    Few hits are point lookups: they pass through the driver, and their
    topics and ids go into the article scan as literal filters (partition
    pruning on topic, row-group min/max on the id-sorted files). More hits are
    fixed first, and broadcast with their texts if these have no more than
    ``MAX_BROADCAST_BYTES`` in all; else a broadcast of their keys cuts the
    articles down before a shuffle join, and beyond ``MAX_BROADCAST_KEYS``
    there is the shuffle join alone."""
    h = hits.withColumn("id", F.col("row_id").cast("long")).drop("row_id")
    arts = articles.select("topic", "id", "answer")
    if bound is None or bound > MAX_BROADCAST_KEYS:
        return arts.join(h, ["topic", "id"])
    if bound <= MAX_LITERALS:
        rows = h.collect()  # at most ``bound`` rows
        topics, ids = ({r[c] for r in rows if r[c] is not None} for c in ("topic", "id"))
        few = F.broadcast(h.sparkSession.createDataFrame(rows, h.schema))
        return arts.filter(F.col("topic").isin(sorted(topics)) & F.col("id").isin(sorted(ids))).join(few, ["topic", "id"])
    checkpoint_dir(h.sparkSession)
    h = h.checkpoint(eager=True)
    size = h.agg(F.coalesce(F.sum(F.octet_length("row_text") + 100), F.lit(0))).first()[0]
    if size <= MAX_BROADCAST_BYTES:
        return arts.join(F.broadcast(h), ["topic", "id"])
    wanted = h.select("topic", "id").distinct()
    return arts.join(F.broadcast(wanted), ["topic", "id"], "left_semi").join(h, ["topic", "id"])


def smart_query(queries: DataFrame, chunk_index: DataFrame, articles: DataFrame,
                k: int = DEFAULT_K, threshold: float = DEFAULT_THRESHOLD,
                qkey: str = "qid", qtext: str = "query") -> DataFrame:
    """T5: for every query, the top-k summary lines above the threshold with
    their full articles: (qid, rank, score, row_text, answer, chunk_start,
    chunk_end, topic). A query with no relevant line has no rows."""
    from topicspark.operators.chunks import summary_lines
    n_q = queries.count()
    lines = summary_lines(chunk_index)
    rel = relevant_lines(queries, lines, threshold, qkey, qtext, n_queries=n_q)
    hits = top_hits(rel, k, qkey)
    out = fetch_articles(hits, articles, bound=k * n_q)
    return out.select(qkey, "rank", "score", "row_text", "answer", "chunk_start",
                      "chunk_end", "topic")


# --- stored search index ----------------------------------------------------
# The chunk index is built offline; the per-line term counts can be built
# with it. A query then reads only the posting rows of the terms that can
# lead it to a hit: the term table is stored in hash buckets of the term, and
# the buckets of these terms are a literal partition filter. Beside it lies a
# dictionary of the terms' line counts, in the same buckets. ``of`` names the
# number of buckets of the stored table.

MAX_PUSHDOWN_TERMS = 100_000
MAX_CANDIDATES = 1_000_000
MAX_FEW = 5000
#: Of the share that commoner terms may have, so much is dropped: the less, the sharper is the candidates' bound.
DROPPED = 0.75
BUCKETS_PER_TASK = 4
#: A batch of queries with more postings than so many for each stored line is scored by one pass over the lines.
SCAN_POSTINGS = 50
LINE_KEY = ["topic", "chunk_start", "chunk_end", "line_no"]
# Stated, as an empty index has no file to tell them and a topic may look like a number.
TERMS = ("chunk_start long, chunk_end long, line_no int, term string, row_id int, cnt long, D2 long, "
         "topic string, of int, bucket int")
COUNTS = "term string, df long, of int, bucket int"
LINES = "chunk_start long, chunk_end long, line_no int, row_id int, row_text string, topic string"


def counts_path(terms_path: str) -> str:
    return terms_path.rstrip("/") + "_counts"


def token_counts(text: Column | str) -> Column:
    """array<struct<term, cnt>>: the distinct tokens of a text, in order."""
    return value_counts(tokens(text))


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + value(x))


def line_term_table(lines: DataFrame) -> DataFrame:
    """(line key..., row_id, D2, term, cnt) for every summary line, counted
    inside the row: no token is shuffled to be counted."""
    counted = lines.select(*LINE_KEY, "row_id", token_counts("row_text").alias("_counts"))
    return (counted.select(*LINE_KEY, "row_id", "_counts", _sum(F.col("_counts"), lambda x: x["cnt"] * x["cnt"]).alias("D2"))
                   .select(*LINE_KEY, "row_id", "D2", F.inline("_counts")))


def write_search_index(chunk_index: DataFrame, terms_path: str, lines_path: str) -> None:
    """Store the search index of a chunk index's summary lines."""
    from topicspark.operators.chunks import summary_lines
    store_lines(summary_lines(chunk_index), terms_path, lines_path)


def store_lines(lines: DataFrame, terms_path: str, lines_path: str) -> None:
    """Store the line texts (partitioned by topic), the term table (in
    buckets of the term) and the number of lines of each term.

    Writers take (a run of ``BUCKETS_PER_TASK`` buckets, salt of the line): a
    term that most lines hold is spread over the writers of its buckets, and a
    sampling pass over the tokenised lines isn't needed. A writer has a file
    for each of its buckets, so files grow with the shuffle partitions alone."""
    from topicspark.sources.store import cluster_for_write
    spark = lines.sparkSession
    (cluster_for_write(lines.select(*LINE_KEY, "row_id", "row_text"), LINE_KEY)
          .write.mode("overwrite").option("partitionOverwriteMode", "static")  # topics that left the index go
          .partitionBy("topic").parquet(lines_path))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, round(n_parts ** 0.5))
    runs = -(-n_parts // salts)
    n_buckets = runs * BUCKETS_PER_TASK
    # Dealt out first: the texts are few bytes next to the work of counting their words.
    (line_term_table(spark_lines(spark, lines_path).repartition(n_parts, *LINE_KEY))
        .withColumn("of", F.lit(n_buckets)).withColumn("bucket", term_bucket(n_buckets))
        .repartition(n_parts, F.floor(F.col("bucket") * F.lit(runs) / F.lit(n_buckets)),
                     F.pmod(F.xxhash64(*LINE_KEY), F.lit(salts)))
        .sortWithinPartitions("bucket", "term")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("of", "bucket").parquet(terms_path))
    (spark.read.schema(TERMS).parquet(terms_path).groupBy("of", "bucket", "term").agg(F.count(F.lit(1)).alias("df"))
        .repartition(n_parts, "bucket").sortWithinPartitions("bucket", "term")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("of", "bucket").parquet(counts_path(terms_path)))


def term_bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(n_buckets)).cast("int")


def spark_lines(spark, lines_path: str) -> DataFrame:
    return spark.read.schema(LINES).parquet(lines_path)


@dataclass
class Candidates:
    rows: DataFrame    # (qid, line key..., row_id, and the sums over kept terms): lines that may score above the threshold
    left: DataFrame    # (qid, left): the dropped terms of each query, array<struct<term, q>>
    keys: list | None  # the candidates themselves where they are at most ``MAX_FEW``
    queries: int | None  # the queries with a term, where they passed through the driver


def _split_terms(terms: list, lines_of: dict[str, int], share: float) -> tuple[list[tuple], dict]:
    """Rows (qid, term, q, Q2, dropped) of the rarest terms of each query,
    without the commonest ones up to ``share`` of its Q2 (``dropped`` of it),
    and these as lists by query."""
    per: dict = {}
    for r in terms:
        per.setdefault(r[0], []).append(r)
    out, left = [], {}
    for qid, rows in per.items():
        total, dropped, kept = sum(r[2] ** 2 for r in rows), 0, []
        left[qid] = []
        for r in sorted(rows, key=lambda r: (-lines_of.get(r[1], 0), r[1])):
            if kept or dropped + r[2] ** 2 > share * total:
                kept.append(r)
            else:
                dropped += r[2] ** 2
                left[qid].append((r[1], r[2]))
        out += [(qid, r[1], r[2], total, dropped) for r in kept]
    return out, left


def _split_frames(terms: DataFrame, counts: DataFrame, qkey: str, share: float) -> tuple[DataFrame, DataFrame]:
    """``_split_terms`` of any number of queries, by joins and windows."""
    whole = Window.partitionBy(qkey)
    order = whole.orderBy(F.col("df").desc(), "term").rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("q") * F.col("q")
    marked = (terms.drop("bucket").join(counts.select("term", "df"), "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
                   .withColumn("Q2", F.sum(square).over(whole))
                   .withColumn("keep", F.sum(square).over(order) > F.lit(share) * F.col("Q2")))
    kept = (marked.withColumn("dropped", F.coalesce(F.sum(F.when(~F.col("keep"), square)).over(whole), F.lit(0)))
                  .filter("keep").select(qkey, "term", "q", "Q2", "dropped"))
    left = marked.groupBy(qkey).agg(F.collect_list(F.when(~F.col("keep"), F.struct("term", "q"))).alias("left"))
    return kept, left  # a list holds terms of one query


@dataclass
class Asked:
    terms: list | None  # (qid, term, q, bucket) of all queries, where they pass through the driver
    lines_of: dict      # lines that hold each of their terms, by the stored counts
    rows: list          # ``_split_terms`` of them
    left: dict

    @property
    def postings(self) -> int:
        """Rows of the kept terms' postings, once for each query that has the term."""
        return sum(self.lines_of.get(r[1], 0) for r in self.rows)


def _terms_of(queries: DataFrame, of: int, qkey: str, qtext: str) -> DataFrame:
    return term_counts(queries, [qkey], qtext).select(qkey, "term", F.col("cnt").alias("q"), term_bucket(of).alias("bucket"))


def ask(queries: DataFrame, terms_path: str, threshold: float = DEFAULT_THRESHOLD,
        qkey: str = "qid", qtext: str = "query") -> Asked:
    """The queries' terms with their line counts, in two small jobs;
    ``terms`` is None where there are more than ``MAX_PUSHDOWN_TERMS``."""
    spark = queries.sparkSession
    stored = _partition_value(spark, terms_path, "of")  # no folder: no postings
    asked = _terms_of(queries, int(stored or 1), qkey, qtext).limit(MAX_PUSHDOWN_TERMS + 1).collect()
    if len(asked) > MAX_PUSHDOWN_TERMS:
        return Asked(None, {}, [], {})
    buckets, lines_of = {r.term: r.bucket for r in asked}, {}
    if buckets and stored:
        known = _of_terms(spark.read.schema(COUNTS).parquet(counts_path(terms_path)), buckets).select("term", "df")
        if len(buckets) > MAX_LITERALS:
            known = known.join(F.broadcast(spark.createDataFrame([(t,) for t in buckets], "term string")), "term")
        lines_of = dict(known.collect())
    return Asked(asked, lines_of, *_split_terms(asked, lines_of, candidate_share(threshold) * DROPPED))


def index_candidates(queries: DataFrame, terms_path: str, threshold: float = DEFAULT_THRESHOLD,
                     qkey: str = "qid", qtext: str = "query", asked: Asked | None = None) -> Candidates:
    """Every (query, line) that can score above ``threshold``, from the
    postings of the queries' rarer terms alone.

    A hit shares terms of more than ``candidate_share`` of the query's squared
    weight. The commonest terms of a query that make up no more than
    ``DROPPED`` of this share are dropped: a line that shares none of the others is no hit. Of the
    lines found, the shared weight of the kept terms bounds the score, with
    all that the dropped ones could add (Cauchy again); only lines whose bound
    is above the threshold are candidates. Queries of up to
    ``MAX_PUSHDOWN_TERMS`` terms pass through the driver (``ask``); more are
    joined."""
    spark = queries.sparkSession
    asked = asked or ask(queries, terms_path, threshold, qkey, qtext)
    kinds = f"{qkey} {queries.schema[qkey].dataType.simpleString()}"
    postings = spark.read.schema(TERMS).parquet(terms_path)
    if asked.terms is not None:
        buckets = {r.term: r.bucket for r in asked.terms}
        postings = _of_terms(postings, {r[1]: buckets[r[1]] for r in asked.rows if r[1] in asked.lines_of})
        kept = F.broadcast(spark.createDataFrame(asked.rows, f"{kinds}, term string, q long, Q2 long, dropped long"))
        rest = F.broadcast(spark.createDataFrame(list(asked.left.items()), f"{kinds}, left array<struct<term: string, q: bigint>>"))
    else:
        terms = _terms_of(queries, int(_partition_value(spark, terms_path, "of") or 1), qkey, qtext)
        counts = spark.read.schema(COUNTS).parquet(counts_path(terms_path))
        kept, rest = _split_frames(terms, counts, qkey, candidate_share(threshold) * DROPPED)
    n_queries = len(asked.left) if asked.terms is not None else None
    c2 = IDF_ONE_OF_TWO * IDF_ONE_OF_TWO
    found = (postings.join(kept, "term").groupBy(qkey, *LINE_KEY)
                     .agg(*[F.first(c).alias(c) for c in ("row_id", "Q2", "D2", "dropped")],
                          F.sum(F.col("q") * F.col("cnt")).alias("dot"), F.sum(F.col("q") * F.col("q")).alias("sq"),
                          F.sum(F.col("cnt") * F.col("cnt")).alias("sd")))
    # The dropped terms may add ``dropped`` to sq and, where there are any, what is left of D2 to sd.
    more = F.when(F.col("dropped") > 0, F.col("D2") - F.col("sd")).otherwise(0)
    sq, sd = F.col("sq") + F.col("dropped"), F.col("sd") + more
    bound = ((F.col("dot") + F.sqrt(F.col("dropped") * more))
             / (F.sqrt(sq + c2 * (F.col("Q2") - sq)) * F.sqrt(sd + c2 * (F.col("D2") - sd))))
    found = found.filter(bound > F.lit(threshold - 1e-9)).drop("dropped")
    if asked.terms is not None and len(asked.terms) <= MAX_LITERALS:
        few = found.limit(MAX_FEW + 1).collect()
        if len(few) <= MAX_FEW:
            return Candidates(F.broadcast(spark.createDataFrame(few, found.schema)), rest, few, n_queries)
    path = scratch_path(spark, "candidates")
    found.write.parquet(path)
    rows = spark.read.schema(found.schema).parquet(path)
    return Candidates(F.broadcast(rows) if rows.count() <= MAX_CANDIDATES else rows, rest, None, n_queries)  # keys and sums only


def _of_terms(table: DataFrame, buckets: dict[str, int]) -> DataFrame:
    """The rows of these terms' buckets, and of few terms only theirs: literal
    lists for the scan (PartitionFilters, PushedFilters)."""
    table = table.filter(f"bucket IN ({', '.join(map(str, sorted(set(buckets.values())))) or 'NULL'})")
    return table.filter(F.col("term").isin(sorted(buckets))) if len(buckets) <= MAX_LITERALS else table


def _partition_value(spark, path: str, column: str) -> str | None:
    """The value of a table's first partition column, from its folder's name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for x in files.listStatus(folder):
        name = x.getPath().getName()
        if name.startswith(column + "="):
            return name.split("=", 1)[1]
    return None


def score_candidates(found: Candidates, lines_path: str, threshold: float = DEFAULT_THRESHOLD,
                     qkey: str = "qid") -> DataFrame:
    """The candidates' exact scores on all terms, where above ``threshold``:
    (qid, line key..., row_id, row_text, score). Only the lines of the
    candidates' topics and chunks are read where the candidates are few, and
    only the dropped terms are looked up in a line."""
    lines = spark_lines(found.rows.sparkSession, lines_path).drop("row_id")
    if found.keys is not None:
        for column in ("topic", "chunk_start"):
            values = sorted({r[column] for r in found.keys if r[column] is not None})
            lines = lines.filter(F.col(column).isin(values)) if len(values) <= MAX_LITERALS else lines
    c2 = IDF_ONE_OF_TWO * IDF_ONE_OF_TWO
    shared = F.filter(F.transform("left", lambda x: F.struct(
        x["q"].alias("q"), F.try_element_at(F.col("_counts"), x["term"]).alias("cnt"))), lambda x: x["cnt"].isNotNull())
    add = lambda name, value: F.col(name) + _sum(F.col("_shared"), value)
    # A line is counted once, before it meets its queries; of few candidates, only their lines.
    if found.keys is not None:
        lines = lines.join(F.broadcast(found.rows.select(*LINE_KEY).distinct()), LINE_KEY, "left_semi")
    sums = (lines.withColumn("_counts", F.map_from_entries(token_counts("row_text")))
                 .join(found.rows, LINE_KEY).join(found.left, qkey).withColumn("_shared", shared)
                 .withColumns({"dot": add("dot", lambda x: x["q"] * x["cnt"]), "sq": add("sq", lambda x: x["q"] * x["q"]),
                               "sd": add("sd", lambda x: x["cnt"] * x["cnt"])}))
    score = (F.col("dot") / (F.sqrt(F.col("sq") + c2 * (F.col("Q2") - F.col("sq")))
                             * F.sqrt(F.col("sd") + c2 * (F.col("D2") - F.col("sd")))))
    return (sums.select(qkey, *LINE_KEY, "row_id", "row_text", score.alias("score"))
                .filter(F.col("score") > F.lit(threshold)))


def stored_scores(queries: DataFrame, terms_path: str, lines_path: str, threshold: float = DEFAULT_THRESHOLD,
                  qkey: str = "qid", qtext: str = "query") -> tuple[DataFrame, int | None]:
    """(qid, line key..., row_id, row_text, score) of the stored lines above
    ``threshold``, and the queries with a term (None where not known).

    Candidates come from the postings, unless the queries have more than
    ``SCAN_POSTINGS`` of them for each line: then a pass over the lines, each
    scored inside its task, moves less than the postings would."""
    asked = ask(queries, terms_path, threshold, qkey, qtext)
    if asked.terms is not None:
        lines = spark_lines(queries.sparkSession, lines_path)
        if asked.postings > SCAN_POSTINGS * max(asked.lines_of.values(), default=0) and asked.postings > SCAN_POSTINGS * lines.count():
            return _lines_above(asked.terms, queries.schema[qkey], lines, threshold), len(asked.left)
    found = index_candidates(queries, terms_path, threshold, qkey, qtext, asked)
    return score_candidates(found, lines_path, threshold, qkey), found.queries


def search_index(queries: DataFrame, terms_path: str, lines_path: str, articles: DataFrame,
                 k: int = DEFAULT_K, threshold: float = DEFAULT_THRESHOLD,
                 qkey: str = "qid", qtext: str = "query") -> DataFrame:
    """T5 against the stored search index; same output as ``smart_query``.

    Besides the job of the result, a search runs a few small ones: the
    queries' terms, their line counts, the candidates, and the hits."""
    scores, n = stored_scores(queries, terms_path, lines_path, threshold, qkey, qtext)
    hits = top_hits(scores, k, qkey)
    n = queries.count() if n is None else n
    return fetch_articles(hits, articles, k * n).select(
        qkey, "rank", "score", "row_text", "answer", "chunk_start", "chunk_end", "topic")


def index_hits(queries: DataFrame, terms_path: str, lines_path: str,
               k: int = DEFAULT_K, threshold: float = DEFAULT_THRESHOLD,
               qkey: str = "qid", qtext: str = "query") -> DataFrame:
    """Top-k lines per query from the stored search index:
    (qid, rank, score, row_text, row_id, line key...)."""
    scores, _ = stored_scores(queries, terms_path, lines_path, threshold, qkey, qtext)
    return top_hits(scores, k, qkey).select(
        qkey, "rank", "score", "row_text", "row_id", *LINE_KEY)
