"""Secret scan: runs that no alphabet holds, runs of one kind."""
from llm import secret_scan

URL = "aB3_x-Zk3vQ9xT7bLpW2mR8sYdNf4hJc6GqXa1Vu0KeIo5"
STD = "Zk3v+Q9xT7bLpW/2mR8sYdNf4hJc6GqXa1Vu0KeIo5"


def test_mixed_runs_are_split():
    for before in ("services/T0/", "a/b/c/d/e/f/"):
        assert secret_scan.parts_of(before + URL) == [(len(before), len(before + URL))]
    both = "a1B2" * 6 + "+-" + "q9Z8" * 6 + "_x"
    assert secret_scan.parts_of(both) == [(0, 25), (25, 52)] and all(secret_scan.score_run(both[i:j]) for i, j in secret_scan.parts_of(both))
    assert secret_scan.parts_of(STD) == [(0, len(STD))]


def test_runs_of_one_kind_are_scored():
    for run in ("QWZXNVKTRPLMHGDJFBSYCAEUIO", "qwzxnvktrplmhgdjfbsycaeuio", "83610529471836205794"):
        assert secret_scan.score_run(run) is not None


def test_token_in_a_path_is_found(spark):
    from llm.tables import ship
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(96003, f"see services/T0/{URL} now")], "doc_id long, text string"))
    got = {r.doc_id: r.spans for r in secret_scan.find_secrets(docs).collect()}
    assert got[96003] == f"random:16:{16 + len(URL)}"
