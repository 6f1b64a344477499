import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from topicspark.operators import audit as A
from topicspark.operators.chunks import assign_chunks, build_chunk_index
from topicspark.operators.summarize import summarize
from topicspark.plans.ingest import prepare_load
from topicspark.plans.q_ingest import _input
from topicspark.sources import csv_io, csv_records, store
from topicspark.sources import fixtures as fx
from topicspark.streaming import ingest as stream


def test_index_invariants(spark):
    art = fx.articles(spark, SF_MID).cache()
    ci = build_chunk_index(art, summarize(art, ["topic", "id"]), 10).cache()
    assert A.chunk_gaps(ci).count() == 0
    covered = A.rows_covered(ci).agg(F.sum("n_rows")).first()[0]
    assert covered == art.count()
    assert [r.topic for r in A.missing_topics(fx.expected_topics(spark, SF_MID), ci).collect()] == ["ghost"]
    ids = [r.id for r in ci.orderBy("id").collect()]
    assert ids == list(range(1, len(ids) + 1))


def test_chunk_edges(spark):
    rows = [("a", i) for i in range(1, 11)] + [("b", i) for i in range(1, 12)] + [("c", 1)]
    df = spark.createDataFrame(rows, "topic string, id long")
    got = {(r.topic, r.id): r.chunk for r in assign_chunks(df, 10).collect()}
    assert {v for (t, _), v in got.items() if t == "a"} == {0}
    assert got[("b", 11)] == 1 and got[("b", 10)] == 0 and got[("c", 1)] == 0
    empty = spark.createDataFrame([], "topic string, id long, question string, answer string")
    assert build_chunk_index(empty, summarize(empty, ["topic", "id"]), 10).count() == 0


def test_ids_dense_and_appended(spark):
    inp = _input(spark, SF_MID)
    res = prepare_load(inp, None, fx.AS_OF, ["conv_id", "turn"])
    path = tempfile.mkdtemp(prefix="ts-test-")
    store.append_articles(res.rows, path)
    again = prepare_load(inp, store.read_articles(spark, path), fx.AS_OF, ["conv_id", "turn"])
    store.append_articles(again.rows, path)
    t = store.read_articles(spark, path)
    per = t.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"),
                                 F.countDistinct("id").alias("d"))
    assert per.filter((F.col("n") != F.col("m")) | (F.col("n") != F.col("d"))).count() == 0
    assert t.count() == 2 * inp.count()


def test_rejects(spark):
    df = spark.createDataFrame([("q", "a", None), (None, None, None), ("q", "a", "  "), ("q", "a", "t")],
                               "question string, answer string, topic string")
    from topicspark.operators.prepare import split_rejects
    good, bad = split_rejects(df)
    assert good.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["empty row", "empty topic", "missing topic column"]


def test_stream_equals_batch_and_replay(spark):
    base = tempfile.mkdtemp(prefix="ts-stream-")
    folder, table, ckpt = stream.stream_paths(base)
    inp = _input(spark, SF_SMALL).select("question", "answer", "topic")
    csv_io.write_input_csv(inp.repartition(3), folder)
    stream.run_ingest_stream(spark, folder, table, ckpt, fx.AS_OF, files_per_batch=1)
    got = stream.read_ingested(spark, table)
    cols = ["topic", "question", "answer"]
    want = inp.select(F.col("topic"), F.coalesce("question", F.lit("")).alias("question"),
                      F.coalesce("answer", F.lit("")).alias("answer"))
    assert got.select(*cols).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*cols)).count() == 0
    per = got.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"),
                                   F.countDistinct("id").alias("d"))
    assert per.filter((F.col("n") != F.col("m")) | (F.col("n") != F.col("d"))).count() == 0
    # Replaying the last batch (same files, same batch id) leaves the table
    # as it was; topics overlap across files, so the id base matters.
    import json
    last = max(int(f) for f in os.listdir(os.path.join(ckpt, "sources", "0")) if f.isdigit())
    assert last >= 1
    with open(os.path.join(ckpt, "sources", "0", str(last))) as fh:
        paths = [json.loads(l)["path"] for l in fh if l.startswith("{")]
    batch = csv_records.lines_of(spark.read, paths)
    before = sorted(tuple(r) for r in stream.read_ingested(spark, table).select("topic", "id", "question").collect())
    stream._batch_writer(table, fx.AS_OF, stream.stream_name(ckpt))(batch, last)
    after = sorted(tuple(r) for r in stream.read_ingested(spark, table).select("topic", "id", "question").collect())
    assert before == after


def test_topics_by_ranges_matches_python_sort(spark):
    seqs = {"a": [(1, 10), (11, 20)], "b": [(1, 10)], "c": [(1, 10), (11, 20), (21, 30)],
            "d": [(1, 10), (21, 30)], "e": [(1, 10), (11, 20)], "f": [(5, 5)], "g": [(1, 10), (11, 20), (21, 25)]}
    rows = [(t, s, e) for t, lst in seqs.items() for s, e in lst]
    ci = spark.createDataFrame(rows, "topic string, chunkStart long, chunkEnd long")
    got = [r.topic for r in A.topics_by_ranges(ci).orderBy("position").collect()]
    want = [t for t, _ in sorted(sorted(seqs.items()), key=lambda x: x[1], reverse=True)]
    # Python's reverse sort keeps ties in input order (a before e): the same as our topic tie-break.
    assert got == want


def test_settled_ranges_are_not_ranked_again(spark):
    import random
    draw = random.Random(5)
    # Lists with long common heads, equal lists, prefixes, and lists that differ at once.
    lists = {f"t{n:02d}": [(10 * i + 1, 10 * i + 10) for i in range(draw.randrange(1, 40))] for n in range(12)}
    lists |= {"x": [(3, 4)], "y": [(5, 9), (11, 20)], "same": lists["t00"],
              "late": lists["t01"][:-1] + [(lists["t01"][-1][0], 10**6)]}
    ci = spark.createDataFrame([(t, s, e) for t, pairs in lists.items() for s, e in pairs], "topic string, chunkStart long, chunkEnd long")
    rounds = []
    got = [r.topic for r in A.topics_by_ranges(ci, rounds).orderBy("position").collect()]
    assert got == [t for t, _ in sorted(sorted(lists.items()), key=lambda x: x[1], reverse=True)]
    assert rounds[0] < sum(map(len, lists.values())) and all(a >= b for a, b in zip(rounds, rounds[1:])) and rounds[-1] < rounds[0] / 2
    # Lists that differ in their first pairs are ranked in no round.
    rounds.clear()
    apart = spark.createDataFrame([(t, 1000 * n + i, 1000 * n + i) for n, t in enumerate("abc") for i in range(300)],
                                  "topic string, chunkStart long, chunkEnd long")
    assert [r.topic for r in A.topics_by_ranges(apart, rounds).orderBy("position").collect()] == ["c", "b", "a"]
    assert rounds == [0]


def test_ingest_csv_in_file_order(spark):
    from topicspark.plans.ingest import ingest_csv
    base = tempfile.mkdtemp(prefix="ts-csv-")
    inp = _input(spark, SF_MID)
    # Three files, each holding a contiguous run of the input order.
    ordered = inp.select("question", "answer", "topic", "conv_id", "turn").repartitionByRange(3, "conv_id", "turn") \
        .sortWithinPartitions("conv_id", "turn")
    ordered.select("question", "answer", "topic").write.option("header", False) \
        .option("quote", '"').option("escape", '"').csv(base + "/in")
    res = ingest_csv(spark, base + "/in", base + "/table", fx.AS_OF)
    got = store.read_articles(spark, base + "/table")
    want = prepare_load(inp, None, fx.AS_OF, ["conv_id", "turn"]).rows
    cols = ["topic", "id", "question", "answer"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0
    assert res.rejects.count() == 0


def test_repeated_loads_use_the_max_id_table(spark):
    from topicspark.plans.ingest import ingest
    base = tempfile.mkdtemp(prefix="ts-loads-")
    inp = _input(spark, SF_SMALL).select("question", "answer", "topic", "conv_id", "turn")
    for _ in range(3):
        ingest(inp, base + "/t", fx.AS_OF, ["conv_id", "turn"])
    t = store.read_articles(spark, base + "/t")
    per = t.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"),
                                 F.countDistinct("id").alias("d"))
    assert per.filter((F.col("n") != F.col("m")) | (F.col("n") != F.col("d"))).count() == 0
    reserved = {r.topic: r.max_id for r in store.read_max_ids(spark, base + "/t").collect()}
    assert reserved == {r.topic: r.m for r in per.collect()}
    assert t.count() == 3 * inp.count()


def test_classify_with_labels_and_topic_sql(spark):
    import pytest
    from topicspark.operators.prepare import classify
    from topicspark.plans.sql import generated_table, topic_sql
    rows = spark.createDataFrame([(1, "q1", "a1", "x"), (2, "q2", "a2", "y")],
                                 "k long, question string, answer string, topic string")
    labels = spark.createDataFrame([(1, "lab1")], "k long, topic string")
    got = {r.k: r.topic for r in classify(rows, labels=labels, key="k").collect()}
    assert got == {1: "lab1", 2: None}
    arts = fx.articles(spark, SF_SMALL)
    n = topic_sql(spark, arts, "src1", "SELECT count(*) AS n FROM test").first().n
    assert n == arts.filter("topic = 'src1'").count()
    with pytest.raises(ValueError):
        topic_sql(spark, arts, "src1", "DROP TABLE test")
    g = generated_table(spark, 3).collect()
    assert [(r.id, r.name) for r in g] == [(1, "Data 1"), (2, "Data 2"), (3, "Data 3")]


def test_chunks_dense_and_sparse_ids_agree(spark):
    rows = [("a", i) for i in (1, 2, 3, 4, 5)] + [("b", i) for i in (3, 9, 10, 40)]
    df = spark.createDataFrame(rows, "topic string, id long")
    from topicspark.operators.chunks import ids_dense_from_one
    assert not ids_dense_from_one(df)
    assert ids_dense_from_one(df.filter("topic = 'a'"))
    got = {(r.topic, r.id): r.chunk for r in assign_chunks(df, 2).collect()}
    assert got == {("a", 1): 0, ("a", 2): 0, ("a", 3): 1, ("a", 4): 1, ("a", 5): 2,
                   ("b", 3): 0, ("b", 9): 0, ("b", 10): 1, ("b", 40): 1}
    dense_a = {(r.topic, r.id): r.chunk for r in assign_chunks(df.filter("topic = 'a'"), 2, dense=False).collect()}
    assert dense_a == {k: v for k, v in got.items() if k[0] == "a"}


def test_empty_load_and_null_question(spark):
    from topicspark.plans.ingest import ingest
    base = tempfile.mkdtemp(prefix="ts-edge-")
    schema = "question string, answer string, topic string, pos long"
    empty = spark.createDataFrame([], schema)
    res = ingest(empty, base + "/t", fx.AS_OF, ["pos"])
    assert res.rejects.count() == 0
    assert store.read_articles(spark, base + "/t").count() == 0
    rows = spark.createDataFrame([(None, "a", "t", 1), ("q", None, "t", 2), (None, None, None, 3)], schema)
    res = ingest(rows, base + "/t", fx.AS_OF, ["pos"])
    got = sorted((r.id, r.question, r.answer) for r in store.read_articles(spark, base + "/t").collect())
    assert got == [(1, "", "a"), (2, "q", "")]
    assert [r.reject_reason for r in res.rejects.collect()] == ["empty row"]


def test_partial_rebuild_keeps_index_ids(spark):
    from topicspark.plans.index import build_index
    base = tempfile.mkdtemp(prefix="ts-rebuild-")
    store.append_articles(fx.articles(spark, SF_SMALL), base + "/a", mode="overwrite")
    full = sorted(tuple(r) for r in build_index(spark, base + "/a", base + "/full", 4)
                  .select("id", "topic", "chunkStart", "summary").collect())
    build_index(spark, base + "/a", base + "/part", 4)
    again = build_index(spark, base + "/a", base + "/part", 4, topics=["src3", "src7"])
    got = sorted(tuple(r) for r in again.select("id", "topic", "chunkStart", "summary").collect())
    assert got == full


def test_index_ids_stay_unique_when_a_topic_grows(spark):
    from topicspark.plans.index import build_index
    base = tempfile.mkdtemp(prefix="ts-grow-")

    def rows(topic, lo, hi):
        return spark.range(lo, hi + 1).select(
            F.lit(topic).alias("topic"), "id", F.lit("").alias("question"), F.lit("one two. three four.").alias("answer"),
            F.array(F.lit("k"), F.concat(F.lit("k"), (F.col("id") % 2).cast("string"))).alias("keywords"),
            F.to_timestamp(F.lit("2024-01-01")).alias("updatedAt"))
    store.append_articles(rows("a", 1, 4).unionByName(rows("b", 1, 4)).unionByName(rows("c", 1, 4)), base + "/a")
    build_index(spark, base + "/a", base + "/i", 2)
    store.append_articles(rows("a", 5, 8), base + "/a")

    def ids(df):
        return {t: sorted(r.id for r in df.collect() if r.topic == t) for t in "abc"}
    assert ids(build_index(spark, base + "/a", base + "/i", 2, topics=["a", "absent"])) == {
        "a": [7, 8, 9, 10], "b": [3, 4], "c": [5, 6]}
    # b would stand at 5 and 6 in a full build, where c still is.
    assert ids(build_index(spark, base + "/a", base + "/i", 2, topics=["b"], method="keywords")) == {
        "a": [7, 8, 9, 10], "b": [11, 12], "c": [5, 6]}
    got = {r.chunkStart: r.summary for r in store.read_chunk_index(spark, base + "/i").filter("topic = 'b'").collect()}
    assert got == {1: '{"k":[1,2],"k0":[2],"k1":[1]}', 3: '{"k":[3,4],"k0":[4],"k1":[3]}'}
    first = ids(build_index(spark, base + "/a", base + "/new", 2, topics=["c", "a"]))
    assert first == {"a": [3, 4, 5, 6], "b": [], "c": [1, 2]}
