"""CSV files cut into many byte ranges, against Python's reader."""
import csv
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from topicspark.operators.prepare import validate
from topicspark.plans.ingest import ingest_csv
from topicspark.sources import csv_io, csv_records, store


@pytest.fixture()
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(n, seed):
    draw = random.Random(seed)
    parts = ["word ", "\n", '"', ",", "\n\n", '""', "\r\n", "é", "a,b", "line\nline", " "]
    text = lambda: "x" + "".join(draw.choices(parts, k=draw.randrange(12))) + "y"
    return [(f"{i} {text()}", text(), draw.choice(["t1", "t 2", "t3"])) for i in range(n)]


def written(folder, name, data, end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows(data)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(out.getvalue())


def test_many_ranges_give_all_records_in_file_order(small_ranges):
    spark, folder = small_ranges, tempfile.mkdtemp(prefix="ts-csv-")
    first, second = rows(120, 1), rows(90, 2) + [("long\n" * 600, "a", "t1"), ("after", "b", "t1")]
    written(folder, "a.csv", first)
    written(folder, "b.csv", second, "\r\n")
    df = csv_io.read_input_csv(spark, folder, with_place=True)
    assert csv_records.lines_of(spark.read, folder).select("_file", "_block").distinct().count() >= 12
    got = [(r.question, r.answer, r.topic) for r in df.orderBy(*csv_records.PLACE).collect()]
    assert got == first + second
    assert sorted(tuple(r) for r in csv_io.read_input_csv(spark, folder).collect()) == sorted(first + second)


def test_load_gives_ids_in_file_order(small_ranges):
    spark, folder = small_ranges, tempfile.mkdtemp(prefix="ts-csv-")
    data = rows(150, 3)
    written(folder, "a.csv", data)
    table = folder + "-table"
    ingest_csv(spark, folder, table, "2024-01-01 00:00:00")
    for topic in ("t1", "t 2", "t3"):
        got = store.scan_topic(spark, table, topic).orderBy("id").select("id", "question").collect()
        want = [q for q, _, t in data if t == topic]
        assert [tuple(r) for r in got] == list(enumerate(want, 1))


def test_headed_file(small_ranges):
    spark, folder = small_ranges, tempfile.mkdtemp(prefix="ts-csv-")
    data = rows(60, 4)
    for name in ("a.csv", "b.csv"):
        written(folder, name, [("Question", "the answer", "Category"), *data])
    df = csv_io.read_headed_csv(spark, folder)
    assert df.columns == ["Question", "the answer", "Category"]
    assert sorted(tuple(r) for r in df.collect()) == sorted(data * 2)
    assert sorted(r[0] for r in csv_io.read_headed_csv(spark, folder, ["Category"]).collect()) == sorted([r[2] for r in data] * 2)


def test_reject_reasons_of_raw_records(spark):
    folder = tempfile.mkdtemp(prefix="ts-csv-")
    text = 'q,a,t\nq,a\n\n"q, with ""comma""","a\n",\n ,"x",  \n   \t\n"only one, quoted"\n,,t\nq,a,t,more\n'
    with open(os.path.join(folder, "a.csv"), "w", newline="") as f:
        f.write(text)
    got = [(r.question, r.topic, r.reject_reason)
           for r in validate(csv_io.read_input_csv(spark, folder, with_place=True)).orderBy(*csv_records.PLACE).collect()]
    assert [x[2] for x in got] == [None, "missing topic column", "empty row", "empty topic", "empty topic", "empty row",
                                   "missing topic column", None, None]
    assert got[3][0] == 'q, with "comma"' and got[7] == ("", "t", None) and got[8][1] == "t"


def test_empty_file(spark):
    folder = tempfile.mkdtemp(prefix="ts-csv-")
    open(os.path.join(folder, "a.csv"), "w").close()
    assert csv_io.read_input_csv(spark, folder).count() == 0
    assert csv_records.read_records(spark, folder).filter(F.col("record") != "").count() == 0
