"""Every line meets the queries inside its task; the joined plan for very many query terms agrees."""
import io
from contextlib import redirect_stdout

import pytest

from topicspark.operators import search

LINES = [("t", 1, 10, 1, "1. red fox red", 1), ("t", 1, 10, 2, "2. blue sky", 2), (None, 1, 10, 1, "3. fox fox sky", 3),
         ("u", 11, 20, 1, "nothing shared", None), ("u", 11, 20, 2, "", None)]
QUERIES = [(1, "red red fox"), (2, "sky"), (None, "Fox blue"), (3, "absent words"), (4, ""), (5, None)]


def frames(spark):
    return (spark.createDataFrame(QUERIES, "qid long, query string"),
            spark.createDataFrame(LINES, "topic string, chunk_start long, chunk_end long, line_no int, row_text string, row_id int"))


def rows(df):
    return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.collect())


def test_no_row_per_shared_term(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        search.score_pairs(*frames(spark)).explain()
    assert "MapInArrow" in out.getvalue() and "Generate " not in out.getvalue()


def test_agrees_with_the_joined_plan_and_any_slice(spark, monkeypatch):
    q, lines = frames(spark)
    got = rows(search.score_pairs(q, lines))
    assert len(got) == 7  # query 1: two lines, 2: two, the one without an id: three
    monkeypatch.setattr(search, "SLICE_PAIRS", 1)
    assert rows(search.score_pairs(q, lines)) == got
    monkeypatch.setattr(search, "MAX_PUSHDOWN_TERMS", 0)
    assert rows(search.score_pairs(q, lines)) == got


@pytest.mark.parametrize("carry", [[], None])
def test_repeated_lines_and_no_queries(spark, carry):
    q, lines = frames(spark)
    assert rows(search.score_pairs(q, lines.union(lines), carry=carry)) == rows(search.score_pairs(q, lines, carry=carry))
    assert search.score_pairs(q.limit(0), lines, carry=carry).count() == 0
    assert search.score_pairs(q, lines.limit(0), carry=carry).count() == 0
