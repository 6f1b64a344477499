"""One id log for batch loads and streams: dense ids, repeated loads, lost steps, two loads at once."""
import os

import pytest
from pyspark.sql import functions as F

from topicspark.plans.ingest import ingest
from topicspark.sources import id_log, store
from topicspark.streaming import ingest as stream

AS_OF = "2024-01-01 00:00:00"


def rows(spark, n, topics="ab", start=0):
    return spark.createDataFrame([(f"q{i}", "a", topics[i % len(topics)], i) for i in range(start, start + n)],
                                 "question string, answer string, topic string, pos long")


def ids(spark, table):
    out = {}
    for r in store.read_articles(spark, table).select("topic", "id", "question").collect():
        out.setdefault(r.topic, {})[r.id] = r.question
    return out


def dense(found):
    return all(sorted(x) == list(range(1, len(x) + 1)) for x in found.values())


def test_batch_stream_batch_into_one_table(spark, tmp_path):
    folder, table, ckpt = stream.stream_paths(str(tmp_path))
    ingest(rows(spark, 5), table, AS_OF, ["pos"])
    os.makedirs(folder)
    for k in range(2):
        with open(os.path.join(folder, f"{k}.csv"), "w") as f:
            f.writelines(f"s{k}{i},x,{'abc'[i % 3]}\n" for i in range(6))
    stream.run_ingest_stream(spark, folder, table, ckpt, AS_OF)
    ingest(rows(spark, 4, "bc", 100), table, AS_OF, ["pos"])
    with open(os.path.join(folder, "2.csv"), "w") as f:
        f.write("late,x,a\n")
    stream.run_ingest_stream(spark, folder, table, ckpt, AS_OF)
    found = ids(spark, table)
    assert dense(found) and {t: len(x) for t, x in found.items()} == {"a": 8, "b": 8, "c": 6}
    assert [found["a"][i] for i in (1, 2, 3, 8)] == ["q0", "q2", "q4", "late"]
    assert found["b"][7] == "q100" and found["c"][5] == "q101"
    assert {r.topic: r.max_id for r in store.read_max_ids(spark, table).collect()} == {"a": 8, "b": 8, "c": 6}


def test_a_load_that_fails_between_its_steps_is_repeated(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    ingest(rows(spark, 4), table, AS_OF, ["pos"], load="first")
    real = store.append_articles

    def dies(df, path, mode="append", load=None):
        if load == "second":
            raise RuntimeError("killed")
        real(df, path, mode, load)
    monkeypatch.setattr(store, "append_articles", dies)
    with pytest.raises(RuntimeError, match="killed"):
        ingest(rows(spark, 4, start=10), table, AS_OF, ["pos"], load="second")
    monkeypatch.setattr(store, "append_articles", real)
    ingest(rows(spark, 2, start=50), table, AS_OF, ["pos"], load="third")
    for _ in range(2):  # the repeated load gets the ids reserved for it, and replaces its rows
        ingest(rows(spark, 4, start=10), table, AS_OF, ["pos"], load="second")
    found = ids(spark, table)
    assert dense(found) and found["a"] == {1: "q0", 2: "q2", 3: "q10", 4: "q12", 5: "q50"}


def test_a_kill_while_reserving_loses_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    ingest(rows(spark, 4), table, AS_OF, ["pos"])

    def dies(*a):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(id_log, "_committed", dies)
        with pytest.raises(RuntimeError):
            ingest(rows(spark, 4, start=10), table, AS_OF, ["pos"])
    ingest(rows(spark, 4, start=20), table, AS_OF, ["pos"])
    assert dense(ids(spark, table)) and id_log.last_version(spark, table) == 2


def test_the_later_of_two_loads_starts_again(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    counts = spark.createDataFrame([("a", 3)], "topic string, n long")
    none = lambda: spark.createDataFrame([], "topic string, max_id long")
    real, other = id_log._committed, []

    def slow(session, source, target):
        if not other:  # another load commits first
            other.append({r.topic: r.max_id for r in id_log.reserve(spark, table, counts, none).collect()} if other.append(1) is None else 0)
        return real(session, source, target)
    monkeypatch.setattr(id_log, "_committed", slow)
    base = {r.topic: r.max_id for r in id_log.reserve(spark, table, counts, none).collect()}
    assert other == [1, {}] and base == {"a": 3} and id_log.last_version(spark, table) == 2
    assert [tuple(r) for r in id_log.reserved(spark, table).collect()] == [("a", 6)]


def test_older_loads_of_a_name_are_refused(spark, tmp_path):
    table = str(tmp_path / "t")
    counts = spark.createDataFrame([("a", 3), (None, 1)], "topic string, n long").filter(F.col("topic").isNotNull())
    none = lambda: spark.createDataFrame([], "topic string, max_id long")
    first = [tuple(r) for r in id_log.reserve(spark, table, counts, none, "s", 4).collect()]
    second = [tuple(r) for r in id_log.reserve(spark, table, counts, none, "s", 5).collect()]
    assert (first, second) == ([], [("a", 3)])
    assert [tuple(r) for r in id_log.reserve(spark, table, counts, none, "s", 5).collect()] == [("a", 3)]
    with pytest.raises(ValueError):
        id_log.reserve(spark, table, counts, none, "s", 4)
