"""CSV and text sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark.operators.sizing import bounded_broadcast
from topicspark.schemas import INPUT
from topicspark.sources import csv_records


def read_input_csv(spark: SparkSession, path: str, multi_line: bool = False,
                   with_place: bool = False) -> DataFrame:
    """Headerless (question, answer, topic) CSV, RFC 4180 quoting.

    Files are read in byte ranges, with quoted newlines (``csv_records``);
    ``multi_line`` takes Spark's own reader instead, one task per file. Empty
    question / answer fields read as '' (the reader gives null); topic stays
    null so that validation rejects it. ``with_place`` adds each record's
    place in file order (``csv_records.PLACE``) and its number of fields
    (``_fields``), and keeps blank records, for validation."""
    if multi_line:
        df = (spark.read.schema(INPUT).option("header", False).option("quote", '"').option("escape", '"')
                   .option("multiLine", True).csv(path))
        return df.select(*_input_fields())
    df = parse_input(csv_records.read_records(spark, path))
    return df if with_place else df.filter("_fields > 0").select("question", "answer", "topic")


def _input_fields() -> list:
    return [F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"), F.col("topic")]


def parse_input(records: DataFrame) -> DataFrame:
    """(question, answer, topic, place, ``_fields``) of CSV records."""
    names = [f.name for f in INPUT.fields]
    return (records.withColumn("_fields", csv_records.field_count(F.col("record")))
                   .withColumn("_row", csv_records.fields(F.col("record"), names))
                   .select("_row.*", "_fields", *csv_records.PLACE)
                   .select(*_input_fields(), "_fields", *csv_records.PLACE))


def read_headed_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                    multi_line: bool = False) -> DataFrame:
    """CSV with header, every column a string; ``columns`` projects.
    Read in byte ranges as ``read_input_csv``; every file has the header of
    the first as its first record."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path))
    if not multi_line:
        text = spark.read.text(path)
        by_folder = [c for c in text.columns if c != "value"]  # of a partitioned folder
        names = [c for c in df.columns if c not in by_folder]
        df = (csv_records.read_records(spark, path).filter("_block > 0 OR _line > 1")
              .filter(csv_records.field_count(F.col("record")) > 0)
              .select("_file", csv_records.fields(F.col("record"), names).alias("_row")))
        if by_folder:
            files = text.select(F.col("_metadata.file_path").alias("_file"), *by_folder).distinct()
            df = df.join(bounded_broadcast(files), "_file")
        df = df.select("_row.*", *by_folder)
    return df.select(*columns) if columns else df


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """Topic list, one per line, stripped; blank lines skipped."""
    return (spark.read.text(path).select(F.btrim(F.col("value"), F.lit(" \t\n\x0b\x0c\r")).alias("topic"))
            .filter(F.col("topic") != ""))


def write_topics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distinct topics, one per line."""
    df.select("topic").filter(F.col("topic").isNotNull()).distinct().write.mode(mode).text(path)


def write_input_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned rows as headerless CSV."""
    (df.select("question", "answer", "topic").write.mode(mode)
       .option("header", False).option("quote", '"').option("escape", '"').csv(path))


def export_topics_csv(df: DataFrame, path: str, topic: str | None = None,
                      mode: str = "overwrite") -> None:
    """Export one topic (or, with ``topic=None``, every topic into its own
    folder) as CSV with header."""
    w = df if topic is None else df.filter(F.col("topic") == F.lit(topic))
    if topic is None:
        # Range-cluster on (topic, row hash): a task writes few topics, and a
        # hot topic is split over many tasks. The input here is a plain scan,
        # so the range sampling pass is cheap.
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        w = (w.withColumn("_h", F.xxhash64(*[c for c in w.columns if c != "topic"]))
              .repartitionByRange(n, "topic", "_h").drop("_h"))
    writer = w.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    if topic is None:
        writer = writer.partitionBy("topic")
    writer.csv(path)


def append_rows(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append string rows to a topic-partitioned table."""
    df.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("topic").parquet(path)


def manual_insert(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Rows of a headed CSV, all strings, tagged with one named topic
    (append them with ``append_rows``)."""
    return read_headed_csv(spark, path).withColumn("topic", F.lit(topic))
