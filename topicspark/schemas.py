"""Explicit schemas (no inference anywhere)."""

from pyspark.sql import types as T

INPUT = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("topic", T.StringType()),
])

ARTICLE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("updatedAt", T.TimestampType()),
    T.StructField("topic", T.StringType()),
])

CHUNK_INDEX = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("chunkStart", T.LongType()),
    T.StructField("chunkEnd", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("updatedAt", T.TimestampType()),
])

TOPICS = T.StructType([T.StructField("topic", T.StringType())])
