"""The paths taken beyond each size bound (no broadcast, no pushed list, no
point lookup) give the same results as the small-size paths."""
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from topicspark.operators import numbering, search, sizing
from topicspark.operators.chunks import build_chunk_index
from topicspark.operators.numbering import number_rows
from topicspark.operators.summarize import summarize
from topicspark.sources import fixtures as fx


def test_numbering_without_broadcasts(spark, monkeypatch):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    monkeypatch.setattr(numbering, "MAX_BROADCAST_ROWS", 0)
    got = number_rows(d, ["source"], ["doc_id"], "id", target_rows=3)
    ref = d.withColumn("ref", F.row_number().over(Window.partitionBy("source").orderBy("doc_id")))
    assert got.join(ref, "doc_id").filter(F.col("id") != F.col("ref")).count() == 0


def test_search_without_pushdown_broadcast_or_lookup(spark, monkeypatch):
    art = fx.articles(spark, SF_SMALL).cache()
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10).cache()
    base = tempfile.mkdtemp(prefix="ts-fb-")
    search.write_search_index(ci, base + "/terms", base + "/lines")
    lines = spark.read.parquet(base + "/lines")
    q = lines.orderBy("topic", "chunk_start", "line_no").limit(3).select(
        (F.monotonically_increasing_id() + 1).alias("qid"), F.col("row_text").alias("query")).cache()
    cols = ["qid", "rank", "row_text", "answer", "chunk_start", "topic"]

    def run():
        out = search.search_index(q, base + "/terms", base + "/lines", art)
        return sorted(tuple(r) for r in out.select(*cols, F.round("score", 9).alias("s")).collect())

    small = run()
    assert len(small) >= 3
    monkeypatch.setattr(search, "MAX_LITERALS", 0)
    monkeypatch.setattr(search, "MAX_FEW", 0)
    assert run() == small
    monkeypatch.setattr(search, "MAX_PUSHDOWN_TERMS", 0)
    monkeypatch.setattr(search, "MAX_BROADCAST_TERMS", 0)
    monkeypatch.setattr(search, "MAX_CANDIDATES", 0)
    assert run() == small
    monkeypatch.setattr(search, "MAX_BROADCAST_BYTES", 0)
    assert run() == small
    monkeypatch.setattr(search, "MAX_BROADCAST_KEYS", 0)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    assert run() == small


def test_bounded_broadcast_falls_back(spark, monkeypatch):
    df = spark.range(10)
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(sizing.bounded_broadcast(df)).lower()
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 5)
    assert "broadcast" not in plan(sizing.bounded_broadcast(df)).lower()
