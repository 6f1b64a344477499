"""Extra columns that are named like an operator's own come back with their values."""
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import host_rules, jaccard_join, line_dedup, soft_mixing, tables, text_stats, words

SF_SMALL = "/root/testdata/sf0.001"
#: Every quoted name in the modules that the stages use, as a column.
NAMES = sorted({name for m in (host_rules, jaccard_join, line_dedup, soft_mixing, tables, text_stats, words)
                for name in re.findall(r'"(\w+)"', open(m.__file__).read())}
               | {"_host_docs", "_host_rejected", "_stats_words", "extra0", "extra7"})


@pytest.fixture(scope="module")
def plain(spark):
    from llm.tables import ship
    ship(spark)
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stage_keeps_clashing_columns(spark, plain, name, stage):
    own = {c.lower() for c in plain.columns}
    extra = list({n.lower(): n for n in NAMES if n.lower() not in own}.values())
    assert len(extra) > 60
    wide = plain.select("*", *[F.concat(F.lit(n + " "), F.col("doc_id")).alias(n) for n in extra], F.lit("dot").alias("a.b c"))
    got = stage(spark, wide, SF_SMALL)
    assert got.columns == wide.columns
    wrong = F.lit(False)
    for n in extra:
        wrong = wrong | ~F.col(n).eqNullSafe(F.concat(F.lit(n + " "), F.col("doc_id")))
    assert got.filter(wrong | (F.col("`a.b c`") != "dot")).count() == 0
    want = stage(spark, plain, SF_SMALL)
    assert sorted(got.select(*plain.columns).collect(), key=str) == sorted(want.collect(), key=str)
