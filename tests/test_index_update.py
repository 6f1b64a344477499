"""Incremental index against full builds, and the gap check over many ranges."""
import tempfile

import pytest
from pyspark.sql import functions as F

from topicspark.operators.audit import chunk_gaps
from topicspark.plans import index
from topicspark.sources import store


def rows(spark, topic, lo, hi, text="one two three. four five six. seven"):
    return spark.range(lo, hi + 1).select(
        F.lit(topic).alias("topic"), "id", F.lit("").alias("question"), F.concat(F.lit(text + " "), F.col("id").cast("string")).alias("answer"),
        F.array(F.lit("k")).alias("keywords"), F.to_timestamp(F.lit("2024-01-01")).alias("updatedAt"))


def held(df):
    return sorted((r.id, r.topic, r.chunkStart, r.chunkEnd, r.summary) for r in df.collect())


@pytest.fixture()
def summarised(monkeypatch):
    """The (topic, id) rows that each update summarises."""
    seen, real = [], index.summarize

    def watched(df, key, **kw):
        seen.append(sorted((r.topic, r.id) for r in df.select("topic", "id").collect()))
        return real(df, key, **kw)
    monkeypatch.setattr(index, "summarize", watched)
    return seen


def test_only_changed_chunks_are_summarised(spark, summarised):
    base = tempfile.mkdtemp(prefix="ts-update-")
    arts, path = base + "/a", base + "/i"
    store.append_articles(rows(spark, "a", 1, 7).unionByName(rows(spark, "b", 1, 6)).unionByName(rows(spark, "c", 1, 2)), arts)
    index.update_index(spark, arts, path, 3)
    assert len(summarised[-1]) == 15
    index.update_index(spark, arts, path, 3)
    assert summarised[-1] == []
    store.append_articles(rows(spark, "a", 8, 11), arts)
    got = index.update_index(spark, arts, path, 3, as_of="2024-02-02 00:00:00")
    assert summarised[-1] == [("a", i) for i in range(7, 12)]  # the last chunk, and the new one
    assert held(got) == held(index.build_index(spark, arts, base + "/full", 3))
    times = {(r.topic, r.chunkStart): str(r.updatedAt)[:7] for r in got.collect()}
    assert times == {("a", 1): "2024-01", ("a", 4): "2024-01", ("a", 7): "2024-02", ("a", 10): "2024-02", ("b", 1): "2024-01",
                     ("b", 4): "2024-01", ("c", 1): "2024-01"}


def test_changed_text_and_lost_notes(spark, summarised):
    base = tempfile.mkdtemp(prefix="ts-update-")
    path = base + "/i"
    store.append_articles(rows(spark, "a", 1, 6).unionByName(rows(spark, "b", 1, 6)), base + "/a")
    index.update_index(spark, base + "/a", path, 3)
    # One row has another text; another index row was overwritten by someone else.
    other = rows(spark, "a", 1, 4).unionByName(rows(spark, "a", 5, 5, "other words here")).unionByName(rows(spark, "a", 6, 6))
    store.append_articles(other.unionByName(rows(spark, "b", 1, 6)), base + "/a2")
    bad = spark.read.parquet(path).filter("topic = 'b'").withColumn("summary", F.when(F.col("chunkStart") == 1, "x").otherwise(F.col("summary")))
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    store.write_chunk_index(bad, path)
    got = index.update_index(spark, base + "/a2", path, 3)
    assert summarised[-1] == [("a", 4), ("a", 5), ("a", 6), ("b", 1), ("b", 2), ("b", 3)]
    assert held(got) == held(index.build_index(spark, base + "/a2", base + "/full", 3))


def test_gaps_across_many_ranges(spark):
    chunks = [(t, s, s + 9) for t in ("a", "b", None) for s in range(1, 400, 10) if not (t == "b" and s in (1, 201, 391)) and (t, s) != ("a", 11)]
    ci = spark.createDataFrame(chunks, "topic string, chunkStart long, chunkEnd long")
    out = chunk_gaps(ci)
    assert sorted((r.topic, r.chunk_end, r.next_start) for r in out.collect()) == [("a", 10, 21), ("b", 200, 211)]
    assert chunk_gaps(ci.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
