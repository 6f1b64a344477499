import math
import re
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from topicspark.operators.chunks import build_chunk_index, summary_lines
from topicspark.operators.search import score_pairs, smart_query
from topicspark.operators.summarize import summarize
from topicspark.sources import fixtures as fx

TOK = re.compile(r"(?u)\b\w\w+\b")


def tfidf_cosine(q, d):
    """Direct evaluation: vectoriser fitted on the two texts (raw counts,
    smoothed idf, L2 norm), then cosine."""
    docs = [Counter(TOK.findall(q.lower())), Counter(TOK.findall(d.lower()))]
    vocab = set(docs[0]) | set(docs[1])
    idf = {t: math.log(3 / (1 + sum(t in x for x in docs))) + 1 for t in vocab}
    vecs = []
    for x in docs:
        v = {t: x[t] * idf[t] for t in x}
        n = math.sqrt(sum(w * w for w in v.values())) or 1.0
        vecs.append({t: w / n for t, w in v.items()})
    return sum(w * vecs[1].get(t, 0.0) for t, w in vecs[0].items())


def test_closed_form_equals_definition(spark):
    art = fx.articles(spark, SF_SMALL)
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10)
    lines = summary_lines(ci).cache()
    q = fx.queries(spark, SF_SMALL).limit(5).cache()
    got = score_pairs(q, lines).join(q, "qid").select("query", "row_text", "score").collect()
    assert len(got) > 100
    for r in got:
        assert abs(r.score - tfidf_cosine(r.query, r.row_text)) < 1e-9


def test_self_query_scores_one_and_threshold_strict(spark):
    art = fx.articles(spark, SF_SMALL)
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10).cache()
    line = summary_lines(ci).orderBy("topic", "chunk_start", "line_no").first()
    q = spark.createDataFrame([(1, line.row_text)], "qid long, query string")
    res = smart_query(q, ci, art, k=5).collect()
    assert res and abs(res[0].score - 1.0) < 1e-9
    assert res[0].row_text == line.row_text
    assert smart_query(q, ci, art, k=5, threshold=1.0 + 1e-9).count() == 0


def test_no_hit_gives_empty_frame(spark):
    art = fx.articles(spark, SF_SMALL)
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10)
    q = spark.createDataFrame([(1, "zzqqxx yyvvww")], "qid long, query string")
    out = smart_query(q, ci, art)
    assert out.count() == 0 and "answer" in out.columns


def test_short_lines_dropped(spark):
    ci = spark.createDataFrame(
        [(1, 1, 2, "t", "'\n1. ab\n\n2. abc\n'", None)],
        "id long, chunkStart long, chunkEnd long, topic string, summary string, updatedAt timestamp")
    rows = summary_lines(ci).select("row_text").collect()
    assert [r.row_text for r in rows] == ["2. abc"]  # 5 characters dropped, 6 kept


def test_stored_index_equals_direct_search(spark):
    import tempfile
    from topicspark.operators.search import search_index, write_search_index
    art = fx.articles(spark, SF_SMALL).cache()
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10).cache()
    base = tempfile.mkdtemp(prefix="ts-sidx-")
    write_search_index(ci, base + "/terms", base + "/lines")
    lines = summary_lines(ci)
    q = fx.queries(spark, SF_SMALL).unionByName(
        lines.limit(5).select((F.monotonically_increasing_id() + 1000).alias("qid"),
                              F.col("row_text").alias("query"))).cache()
    cols = ["qid", "rank", "score", "row_text", "answer", "chunk_start", "chunk_end", "topic"]
    a = sorted(tuple(r) for r in smart_query(q, ci, art).select(*cols).withColumn("score", F.round("score", 9)).collect())
    b = sorted(tuple(r) for r in search_index(q, base + "/terms", base + "/lines", art)
               .select(*cols).withColumn("score", F.round("score", 9)).collect())
    assert a == b and len(a) >= 5


def test_exact_copies_tie_at_one(spark):
    from conftest import SF_MID
    art = fx.articles(spark, SF_MID).cache()
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10).cache()
    lines = summary_lines(ci).withColumn("body", F.regexp_replace("row_text", r"^\d+\.\s*", ""))
    dup = (lines.groupBy("body").agg(F.count(F.lit(1)).alias("n"))
                .filter((F.col("n") >= 3) & (F.length("body") > 40)).orderBy("body").first())
    assert dup is not None
    q = spark.createDataFrame([(1, dup.body)], "qid long, query string")
    res = smart_query(q, ci, art, k=50).orderBy("rank").collect()
    # Every copy is found. The row id is part of a line's text: one-digit ids
    # are no token (a copy scores 1.0), longer ids add one token each, so
    # copies tie in groups; within a tie, order is topic, chunk, line.
    copies = {r.row_text for r in lines.filter(F.col("body") == dup.body).collect()}
    assert copies <= {r.row_text for r in res} and len(copies) >= 3
    groups = {}
    for r in res:
        groups.setdefault(round(r.score, 9), []).append((r.topic, r.chunk_start, r.rank))
    assert any(len(g) >= 2 for g in groups.values())
    for g in groups.values():
        assert [x[:2] for x in g] == sorted(x[:2] for x in g)


def test_threshold_is_strict(spark):
    from topicspark.operators.search import relevant_lines
    lines = spark.createDataFrame(
        [("t", 1, 2, 0, "12. alpha beta gamma", 12), ("t", 1, 2, 1, "13. alpha delta", 13)],
        "topic string, chunk_start long, chunk_end long, line_no int, row_text string, row_id int")
    q = spark.createDataFrame([(1, "alpha beta")], "qid long, query string")
    scores = {r.line_no: r.score for r in score_pairs(q, lines).collect()}
    t = scores[0]
    kept = {r.line_no for r in relevant_lines(q, lines, threshold=t).collect()}
    assert 0 not in kept  # a score equal to the threshold is not above it
    assert kept == {n for n, s in scores.items() if s > t}


def test_stored_index_prunes_buckets_and_may_be_empty(spark):
    from topicspark.operators.search import search_index, write_search_index
    base = tempfile.mkdtemp(prefix="ts-buckets-")
    ci = spark.createDataFrame(
        [(1, 1, 2, "2024", "'\n1. hot alpha beta\n\n2. hot gamma delta\n'")],
        "id long, chunkStart long, chunkEnd long, topic string, summary string")
    arts = spark.createDataFrame([("2024", 1, "one"), ("2024", 2, "two")], "topic string, id long, answer string")
    terms = " ".join(f"word{i}" for i in range(3))
    q = spark.createDataFrame([(1, "hot alpha beta"), (2, terms)], "qid long, query string")
    write_search_index(ci, base + "/terms", base + "/lines")
    out = search_index(q, base + "/terms", base + "/lines", arts)
    assert [(r.qid, r.answer, r.topic) for r in out.collect()] == [(1, "one", "2024")]
    from topicspark.operators.search import index_hits
    plan = index_hits(q, base + "/terms", base + "/lines")._jdf.queryExecution().toString()
    assert any("PartitionFilters" in line and "bucket" in line for line in plan.splitlines())
    write_search_index(ci.limit(0), base + "/terms0", base + "/lines0")
    assert search_index(q, base + "/terms0", base + "/lines0", arts).count() == 0


def _stored(spark, rows):
    """A stored index of (line_no, text) rows of one chunk."""
    from topicspark.operators.search import store_lines
    base = tempfile.mkdtemp(prefix="ts-cand-")
    lines = spark.createDataFrame([("t", 1, 2, i, x, i) for i, x in rows],
                                  "topic string, chunk_start long, chunk_end long, line_no int, row_text string, row_id int")
    store_lines(lines, base + "/terms", base + "/lines")
    return base, lines


def test_candidates_lose_no_hit(spark):
    """Hits of several thresholds, against scores of all pairs on texts of common and rare terms."""
    import random

    from topicspark.operators.search import index_candidates, score_candidates
    draw = random.Random(3)
    vocabulary = [f"w{i:02d}" for i in range(40)]
    text = lambda: " ".join(draw.choices(vocabulary, [1 / (i + 1) for i in range(40)], k=draw.randrange(1, 14)))
    base, lines = _stored(spark, [(i, text()) for i in range(250)] + [(250, "w00 " * 30), (251, "..."), (252, "w00 w00 w00 w39")])
    q = spark.createDataFrame([(i, text()) for i in range(40)] + [(40, "w00 w01"), (41, "w00 w00 w00 w39"), (42, "?"), (43, "zz w00")],
                              "qid long, query string").cache()
    every = {(r.qid, r.line_no): r.score for r in score_pairs(q, lines).collect()}
    scored = 0
    for t in (0.0, 0.2, 0.35, 0.5, 0.7, 0.9, 0.999, 1.0):
        found = index_candidates(q, base + "/terms", t)
        got = {(r.qid, r.line_no): r.score for r in score_candidates(found, base + "/lines", t).collect()}
        assert got.keys() == {p for p, s in every.items() if s > t}, t
        assert all(abs(s - every[p]) < 1e-12 for p, s in got.items())
        scored += found.rows.count() if t == 0.5 else 0
    assert scored < len(every) / 2  # of 40 words; most pairs of few words share a common one


def test_postings_of_common_terms_are_not_read(spark):
    from topicspark.operators.search import index_candidates
    base, _ = _stored(spark, [(i, f"the of and with rare{i}x other{i}y") for i in range(60)])
    q = spark.createDataFrame([(1, "the of rare7x other7y rare8x"), (2, "the of and with")], "qid long, query string")
    found = index_candidates(q.filter("qid = 1"), base + "/terms")
    assert 7 in {r["line_no"] for r in found.keys} <= {7, 8}
    from topicspark.operators import search
    seen = []
    real = search._of_terms
    search._of_terms = lambda t, b: seen.append(sorted(b)) or real(t, b)
    try:
        index_candidates(q, base + "/terms")
    finally:
        search._of_terms = real
    assert seen[0] == ["and", "of", "other7y", "rare7x", "rare8x", "the", "with"]
    # The first query drops "of", the second, of common terms only, one of them too: "and" stays unread.
    assert seen[1] == ["of", "other7y", "rare7x", "rare8x", "the", "with"]


def test_token_counts(spark):
    from topicspark.operators.search import token_counts
    rows = [(1, "b a B cc cc CC dd"), (2, ""), (3, None), (4, "x y"), (5, "word " * 30000)]
    got = {r.i: r.c for r in spark.createDataFrame(rows, "i int, t string").select("i", token_counts("t").alias("c")).collect()}
    assert [tuple(x) for x in got[1]] == [("cc", 3), ("dd", 1)] and [tuple(x) for x in got[5]] == [("word", 30000)]
    assert not got[2] and not got[3] and not got[4]
