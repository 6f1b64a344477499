from pyspark.sql import functions as F

from topicspark.functions import text as X


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"s {typ}").select(expr(F.col("s")).alias("r")).first()["r"]


def test_split_getline_rules(spark):
    cases = {"": [], "a": ["a"], "a,": ["a"], "a,,b": ["a", "", "b"], ",": [""], "a,b,,": ["a", "b", ""]}
    for s, want in cases.items():
        assert _one(spark, lambda c: X.split_getline(c), s) == want, s


def test_row_id_and_render(spark):
    assert _one(spark, X.row_id_of_line, "12. foo. bar") == 12
    assert _one(spark, X.row_id_of_line, "foo. bar") is None
    df = spark.createDataFrame([(3, "a\nb")], "id int, s string")
    assert df.select(X.render_line("id", "s")).first()[0] == "3. a b"


def test_fold_and_empty(spark):
    df = spark.createDataFrame([(2, "2. b"), (1, "1. a")], "id long, line string")
    got = df.agg(X.fold_lines(F.collect_list(F.struct("id", "line")))).first()[0]
    assert got == "'\n1. a\n\n2. b\n'"
    empty = df.filter("id < 0").agg(X.fold_lines(F.collect_list(F.struct("id", "line")))).first()[0]
    assert empty == X.NO_SUMMARIES


def test_safe_cast_parse_and_epoch(spark):
    assert _one(spark, lambda c: X.safe_cast(c, "int", -1), "x1") == -1
    assert _one(spark, lambda c: X.safe_cast(c, "int", -1), "42") == 42
    assert _one(spark, X.parse_ts, "2024-01-02 03:04:05") is not None
    assert _one(spark, X.parse_ts, "not a time") is None
    assert _one(spark, lambda c: F.date_format(X.epoch_to_ts(c), X.TS_FORMAT), 0, "long") == "1970-01-01 00:00:00"


def test_tokens_and_keyword_render(spark):
    assert _one(spark, X.tokens, "A bc, Déjà-vu 7 42_x!") == ["bc", "déjà", "vu", "42_x"]
    df = spark.createDataFrame([("b", [2, 3]), ("a", [1])], "keyword string, ids array<long>")
    got = df.agg(X.render_keyword_map(F.collect_list(F.struct("keyword", "ids"))),
                 X.keyword_map_json(F.collect_list(F.struct("keyword", "ids")))).first()
    assert got[0] == "{'a': [1], 'b': [2,3]}"
    assert got[1] == '{"a":[1],"b":[2,3]}'
    assert _one(spark, X.thousands, 1234567, "long") == "1,234,567"
    assert _one(spark, lambda c: X.reported_chunks(c, 10), 20, "long") == 2


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


def getline_model(s, sep=","):
    if s == "":
        return []
    parts = s.split(sep)
    return parts[:-1] if parts[-1] == "" else parts


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab,", max_size=8), min_size=1, max_size=15))
def test_split_getline_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, s string")
    got = {r.i: r.p for r in df.select("i", X.split_getline("s").alias("p")).collect()}
    assert got == {i: getline_model(v) for i, v in enumerate(values)}
