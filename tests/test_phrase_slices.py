"""Phrases are counted by an Arrow function, in slices of any size."""
import io
from contextlib import redirect_stdout

from topicspark.operators import keywords


def test_slices_of_any_size_agree(spark, monkeypatch):
    df = spark.createDataFrame([("t", 1, "aa bb aa bb aa"), ("t", 2, ""), ("t", 3, None), (None, 4, "bb"), ("u", 5, "cc aa Été 12 12")],
                               "topic string, id long, answer string")

    def got():
        return sorted(str(tuple(r)) for r in keywords.keyphrases(df, ["topic", "id"], "answer", 3).collect())
    whole = got()
    assert len(whole) == 7 and "('t', 1, 1, 'aa', " in " ".join(whole)
    monkeypatch.setattr(keywords, "SLICE_TOKENS", 1)
    assert got() == whole
    counted = df.select("answer", keywords._phrase_counts()(keywords.tokens("answer")).alias("c"))
    assert [(x.phrase, x.tf) for x in counted.first().c] == [("aa", 3), ("bb", 2), ("aa bb", 2), ("bb aa", 2)]
    out = io.StringIO()
    with redirect_stdout(out):
        counted.explain()
    assert "ArrowEvalPython" in out.getvalue()
