"""Summaries are made inside their own row: no row per token, none where they are not read."""
import io
from contextlib import redirect_stdout

import pytest

from topicspark.operators import summarize as S
from topicspark.operators.chunks import build_chunk_index

ROWS = [("t", 1, "", ""), ("t", 2, None, None), ("t", 3, "Q?", "red fox. red fox. blue sky! ...\n \n--- \ngreen red"),
        (None, 4, "Why so?", "one two\tthree. four five\nfive five"), ("u", 5, "", "\t\nÉté été. straße STRASSE 12! x"),
        ("u", None, "a b. cc dd", "dd cc. ee")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "topic string, id long, question string, answer string")


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_no_row_per_token(spark):
    p = plan(S.summarize(frame(spark), ["topic", "id"]))
    assert "+- Window" not in p and "Generate " not in p
    assert p.count("Exchange hashpartitioning") <= 2  # the texts, then the summaries


def test_summaries_that_are_not_read_are_not_made(spark):
    df = frame(spark, [r for r in ROWS if r[0] and r[1]])
    index = build_chunk_index(df, S.summarize(df, ["topic", "id"]), 2)
    assert "ArrowEvalPython" in plan(index) and "Generate " not in plan(index)
    p = plan(index.select("topic", "chunkStart", "chunkEnd"))
    assert "ArrowEvalPython" not in p and "regexp_extract_all" not in p


@pytest.mark.parametrize("method", S.METHODS)
def test_slices_of_any_size_agree(spark, monkeypatch, method):
    def got():
        return sorted((str(r) for r in S.summarize(frame(spark), ["topic", "id"], method=method).collect()))
    whole = got()
    assert len(whole) == len(ROWS)
    for size in (1, 5, 9):
        monkeypatch.setattr(S, "SLICE_TOKENS", size)
        assert got() == whole


def test_one_row_per_key(spark):
    got = S.summarize(frame(spark, [("t", 1, "", "a b. cc dd.")] * 2 + [(None, None, "", "ee")] * 2), ["topic", "id"]).collect()
    assert sorted((str(r.topic), r.summary) for r in got) == [("None", "ee"), ("t", "a b. cc dd.")]
