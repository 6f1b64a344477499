"""Writers are sized by measured bytes: one topic of long texts, few ids."""
import os
import random

import pytest
from pyspark.sql import functions as F

from topicspark.schemas import ARTICLE
from topicspark.sources import store

TARGET = 1 << 20


@pytest.fixture()
def small_target(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, str(TARGET))
    yield
    spark.conf.set(name, old)


def _rows(spark, n):
    # About 4 KB of text that does not compress, in 64 input partitions.
    text = F.concat_ws("", *[F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 512) for i in range(64)])
    return spark.range(1, n + 1, numPartitions=64).select(
        F.lit("long").alias("topic"), "id", F.lit("").alias("question"), text.alias("answer"),
        F.array(F.lit("k")).alias("keywords"), F.lit("2024-01-01").cast("timestamp").alias("updatedAt"))


def test_long_texts_are_spread_by_bytes(spark, tmp_path, small_target):
    path = str(tmp_path / "articles")
    store.append_articles(_rows(spark, 3000).select(*ARTICLE.fieldNames()), path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) > 6
    # A file is at most the target and what one input partition adds to it.
    assert max(os.path.getsize(f) for f in files) < 1.5 * TARGET
    assert store.read_articles(spark, path).count() == 3000
    for f in random.Random(0).sample(files, 5):
        ids = [r["id"] for r in spark.read.parquet(f).select("id").collect()]
        assert ids == sorted(ids)


def test_small_topics_share_writers(spark, tmp_path, small_target):
    path = str(tmp_path / "articles")
    rows = _rows(spark, 40).withColumn("topic", F.concat(F.lit("t"), F.col("id") % 4)).select(*ARTICLE.fieldNames())
    store.append_articles(rows, path)
    files = [f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 4


@pytest.mark.parametrize("name,wanted", [
    ("P6", ["GreaterThanOrEqual(id,11)", "LessThanOrEqual(id,20)"]),
    ("P7", ["EqualTo(id,7)", "topic", "= src1"]),
    ("Q1", ["PartitionFilters", "= src3"]),
])
def test_registered_lookups_reach_the_scan(spark, name, wanted):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert all(w in scan for w in wanted), scan
