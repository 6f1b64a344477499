import math
import re
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from topicspark.operators.keywords import chunk_prompts, keyphrases, keyword_index
from topicspark.sources import fixtures as fx

TOK = re.compile(r"(?u)\b\w\w+\b")


def test_keyphrases_match_python(spark):
    art = fx.articles(spark, SF_SMALL).select("topic", "id", "answer").cache()
    docs = {(r.topic, r.id): r.answer for r in art.collect()}
    grams = {}
    for k, text in docs.items():
        t = TOK.findall(text.lower())
        grams[k] = Counter(t + [f"{a} {b}" for a, b in zip(t, t[1:])])
    df = Counter(p for g in grams.values() for p in g)
    n = len(docs)
    want = {}
    for k, g in grams.items():
        scored = sorted(((round(c * (math.log((1 + n) / (1 + df[p])) + 1), 9), p) for p, c in g.items()),
                        key=lambda x: (-x[0], x[1]))[:5]
        want[k] = [p for _, p in scored]
    got = {}
    for r in keyphrases(art, ["topic", "id"], "answer", 5).orderBy("topic", "id", "rank").collect():
        got.setdefault((r.topic, r.id), []).append(r.phrase)
    assert got == {k: v for k, v in want.items() if v}


def test_keyword_index_and_prompts(spark):
    rows = spark.createDataFrame([("b", 1, ["x", "y"]), ("b", 2, ["x"]), ("b", 3, []), ("b", 4, ["x", "x"])],
                                 "topic string, id long, keywords array<string>")
    idx = {(r.chunk, r.keyword): r.ids for r in keyword_index(rows, 2).collect()}
    assert idx == {(0, "x"): [1, 2], (0, "y"): [1], (1, "x"): [4, 4]}
    arts = spark.createDataFrame([("t", 1, "q", "a")], "topic string, id long, question string, answer string") \
        .withColumn("keywords", F.array(F.lit("k1"))).withColumn("updatedAt", F.to_timestamp(F.lit(fx.AS_OF)))
    p = chunk_prompts(arts, 500).first().prompt
    assert p.endswith("1 a q k1  1704067200\n") and "Below are 500 data" in p


def test_hot_phrase_is_split(spark):
    from pyspark.sql import functions as F

    from topicspark.operators.keywords import keyphrases
    words = F.concat(F.when(F.col("id") % 10 > 0, F.lit("hot ")).otherwise(F.lit("")),
                     F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5000)).cast("string"))
                                        for i in range(3)]))
    docs = spark.range(20000).select("id", words.alias("text"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = keyphrases(docs, ["id"], "text", top=1)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
