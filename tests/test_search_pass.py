"""A broad batch of queries is one pass over the lines, and a stored index has few files."""
import glob
import io
import random
import tempfile
from contextlib import redirect_stdout

import pytest

from conftest import SF_SMALL
from topicspark.operators import search
from topicspark.plans import q_audit

SCHEMA = "topic string, chunk_start long, chunk_end long, line_no int, row_text string, row_id int"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def frames(spark):
    draw = random.Random(5)
    vocabulary = [f"w{i:02d}" for i in range(30)]
    text = lambda: " ".join(draw.choices(vocabulary, [1 / (i + 1) for i in range(30)], k=draw.randrange(1, 10)))
    lines = [("t", 1, 2, i, text(), i) for i in range(150)] + [("t", 1, 2, 150, "", 1), (None, 1, 2, 151, "w00 w01", 1), ("u", None, 2, 1, "w00 w01", 1)]
    asked = [(i, text()) for i in range(30)] + [(30, "w00 w01"), (31, ""), (32, None), (None, "w00 w01"), (33, "zz"), (0, "w29 w28")]
    return spark.createDataFrame(asked, "qid long, query string").cache(), spark.createDataFrame(lines, SCHEMA).cache()


def rows(df):
    return sorted((r.qid, r.topic, r.line_no, r.row_text, r.row_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("threshold", [0.0, 0.5, 0.8])
def test_one_pass_and_candidates_agree(spark, monkeypatch, threshold):
    q, lines = frames(spark)
    base = tempfile.mkdtemp(prefix="ts-pass-")
    search.store_lines(lines, base + "/terms", base + "/lines")
    direct = rows(search.relevant_lines(q, lines, threshold))
    stored = lambda: search.stored_scores(q, base + "/terms", base + "/lines", threshold)
    monkeypatch.setattr(search, "SCAN_POSTINGS", 10**9)
    by_postings, n = stored()
    assert "MapInArrow" not in plan(by_postings) and rows(by_postings) == direct
    monkeypatch.setattr(search, "SCAN_POSTINGS", 0)
    by_lines, m = stored()
    assert "MapInArrow" in plan(by_lines) and rows(by_lines) == direct and n == m
    monkeypatch.setattr(search, "MAX_PUSHDOWN_TERMS", 0)
    assert rows(search.relevant_lines(q, lines, threshold)) == direct
    assert len(direct) > 5 and (threshold or len(direct) > 500)


def test_direct_search_writes_no_index(spark, monkeypatch):
    q, lines = frames(spark)
    monkeypatch.setattr(search, "store_lines", lambda *a: pytest.fail("an index for one batch of queries"))
    assert "MapInArrow" in plan(search.relevant_lines(q, lines))
    assert search.relevant_lines(q.limit(0), lines).count() == search.relevant_lines(q, lines.limit(0)).count() == 0


def test_files_of_the_index_grow_with_the_partitions(spark):
    _, lines = frames(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "36")
        base = tempfile.mkdtemp(prefix="ts-files-")
        search.store_lines(lines, base + "/terms", base + "/lines")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    # Six runs of buckets, six salts: 36 writers of four buckets (they had 24 each).
    buckets = glob.glob(base + "/terms/of=*/bucket=*")
    files = glob.glob(base + "/terms/of=*/bucket=*/*.parquet")
    assert len(buckets) <= 24 and len(files) <= 36 * search.BUCKETS_PER_TASK


def test_words_of_a_line_are_counted_without_a_shuffle(spark):
    p = plan(q_audit.j5_term_join(spark, SF_SMALL))
    assert not any("Exchange hashpartitioning" in x and "term#" in x and "topic#" in x for x in p.splitlines()), p
