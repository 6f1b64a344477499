"""T9_keywords: bounds and keyword maps of the chunks in one pass, nothing large sent through the driver."""
import io
from contextlib import redirect_stdout

import pytest

from topicspark.operators import numbering
from topicspark.operators.keywords import keyword_chunks
from topicspark.plans.index import plan_keyword_index


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def rows(spark, tmp_path):
    data = [("b", 1, ["x", "y"]), ("b", 4, ["x"]), ("b", 6, []), ("b", 9, None), ("c", 2, ["x", "x"]), (None, 1, ["z"])]
    spark.createDataFrame(data, "topic string, id long, keywords array<string>").write.parquet(f"{tmp_path}/r")
    return spark.read.parquet(f"{tmp_path}/r")


def test_chunks_without_keywords_and_sparse_ids(rows):
    got = {(r.topic, r.chunkStart, r.chunkEnd): (r.id, r.summary) for r in plan_keyword_index(rows, 2).collect()}
    assert got == {("b", 1, 4): (1, '{"x":[1,4],"y":[1]}'), ("b", 6, 9): (2, "{}"), ("c", 2, 2): (3, '{"x":[2,2]}')}


def test_no_join_of_chunks_with_their_maps(rows):
    assert "Join" not in plan(keyword_chunks(rows, 2))


def test_numbered_table_is_not_broadcast(rows, monkeypatch):
    monkeypatch.setattr(numbering, "DIRECT_ROWS", 0)
    p = plan(numbering.number_rows(rows, ["topic"], ["id"], "n"))
    assert "SortMergeJoin" in p and p.count("BroadcastExchange") == 1  # the table of groups and buckets
    assert sorted(r.n for r in numbering.number_rows(rows, ["topic"], ["id"], "n").collect()) == [1, 1, 1, 2, 3, 4]
