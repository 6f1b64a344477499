"""Refused writes, reads that must fail, and the query guard."""
import os

import pytest
from pyspark.sql import functions as F

from topicspark.plans.sql import topic_sql
from topicspark.sources import csv_io, store
from topicspark.streaming import ingest as stream

AS_OF = "2024-01-01 00:00:00"


@pytest.mark.parametrize("text", [
    "FROM test INSERT INTO other SELECT *", "WITH t AS (SELECT 1) INSERT INTO other SELECT * FROM t",
    "DROP TABLE test", "INSERT INTO test VALUES (1)", "", "not a query at all ;;"])
def test_only_queries_run(spark, text):
    rows = spark.createDataFrame([(1, "a")], "id long, topic string")
    with pytest.raises(ValueError):
        topic_sql(spark, rows, "a", text)


@pytest.mark.parametrize("text", ["(SELECT count(*) AS n FROM test)", "-- a comment\nSELECT count(*) AS n FROM test",
                                  "WITH t AS (SELECT * FROM test) SELECT count(*) AS n FROM t"])
def test_queries_in_any_form_run(spark, text):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, topic string")
    assert topic_sql(spark, rows, "a", text).collect()[0]["n"] == 1


def test_unreadable_table_raises(spark, tmp_path):
    bad = tmp_path / "max_ids" / "v-0000000001"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"not parquet at all")
    assert store.read_max_ids(spark, str(tmp_path / "absent")) is None
    with pytest.raises(Exception):
        store.read_max_ids(spark, str(tmp_path / "max")).collect()


def test_stream_keeps_rejects_and_earlier_data(spark, tmp_path):
    folder, table, ckpt = stream.stream_paths(str(tmp_path))
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("q1,a1,t\nq2,a2,\nq3,a3,t\n")
    stream.run_ingest_stream(spark, folder, table, ckpt, AS_OF)
    assert stream.read_ingested(spark, table).count() == 2
    assert spark.read.parquet(stream.rejects_path(table)).select("question").collect()[0][0] == "q2"
    os.rename(ckpt, ckpt + "-away")
    with pytest.raises(ValueError):
        stream.run_ingest_stream(spark, folder, table, ckpt, AS_OF)
    assert stream.read_ingested(spark, table).count() == 2
    stream.run_ingest_stream(spark, folder, table, ckpt + "-new", AS_OF)  # another stream adds its own rows
    assert sorted((r.topic, r.id) for r in stream.read_ingested(spark, table).collect()) == [("t", i) for i in (1, 2, 3, 4)]


def test_overwrite_replaces_every_topic(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "x string, topic string")
    csv_io.append_rows(rows, path)
    csv_io.append_rows(rows.filter("topic = 'a'"), path)
    assert spark.read.parquet(path).count() == 3
    csv_io.append_rows(rows.filter("topic = 'a'"), path, mode="overwrite")
    assert [r[0] for r in spark.read.parquet(path).select(F.col("topic").cast("string")).collect()] == ["a"]


def test_topic_list_is_stripped(spark, tmp_path):
    (tmp_path / "topics.txt").write_text("\tone \r\n\n two\n")
    assert sorted(r[0] for r in csv_io.read_topics(spark, str(tmp_path / "topics.txt")).collect()) == ["one", "two"]


def test_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from topicspark.session import checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
