"""CSV records of splittable files, with quoted newlines and in file order.

Spark's multi-line CSV reader takes a file as one task. Here the files are
read as lines, in as many byte ranges as Spark cuts them into, and records are
found from the parity of the quotes before a line:

1. each range counts the quotes of its lines (a window over one range), and a
   table of one row per range gets the parity at every range's start by a
   prefix sum over the ranges of its file, with the last record start before
   it;
2. a line at whose start the parity is even begins a record. If it is even at
   its end too, the line is the record. Only lines of longer records meet in
   a group, that of their record's place.

A doubled quote inside a quoted field counts twice, so it changes nothing. A
quote that is never closed takes the rest of its file into one record, as with
any reader of quoted newlines. The order of records is (file, byte offset of
the range, line in the range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PLACE = ["_file", "_block", "_line"]


def lines_of(reader, path: str) -> DataFrame:
    """Lines of text files by ``spark.read`` or ``spark.readStream``:
    (_file, _block, value). A carriage return stays in its line."""
    return reader.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value")


def records(lines: DataFrame) -> DataFrame:
    """(_file, _block, _line, record) of ``lines_of``, a row per record; blank
    lines outside quotes are records too."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    of_split = Window.partitionBy("_file", "_block").orderBy("_id")
    until = of_split.rowsBetween(Window.unboundedPreceding, -1)
    marked = (lines.withColumn("_id", F.monotonically_increasing_id())
              .withColumn("_odd", (quotes % 2).cast("int"))
              .withColumn("_line", F.row_number().over(of_split).cast("long"))
              .withColumn("_before", F.coalesce(F.sum("_odd").over(until), F.lit(0)) % 2))
    # The last line of a range that begins a record, for either parity at the range's start.
    last = [F.max(F.when(F.col("_before") == p, F.col("_line"))).alias(f"_last{p}") for p in (0, 1)]
    splits = marked.groupBy("_file", "_block").agg(F.sum("_odd").alias("_sum"), *last)
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (splits.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) % 2)
              .withColumn("_mine", F.when(F.col("_start") == 0, F.col("_last0")).otherwise(F.col("_last1")))
              .withColumn("_open", F.last(F.when(F.col("_mine").isNotNull(), F.struct(
                  F.col("_block").alias("b"), F.col("_mine").alias("l"))), ignorenulls=True).over(earlier))
              .select("_file", "_block", "_start", "_open"))
    begins = (F.col("_start") + F.col("_before")) % 2 == 0
    # Lines and ranges are dealt by the same keys: the lines stay where the window has put them.
    placed = (marked.join(splits, ["_file", "_block"]).withColumn("_begins", begins)
              .withColumn("_at", F.max(F.when(F.col("_begins"), F.col("_line"))).over(of_split)))
    single = F.col("_begins") & (F.col("_odd") == 0)
    first = F.when(F.col("_at").isNotNull(), F.struct(F.col("_block").alias("b"), F.col("_at").alias("l"))).otherwise(F.col("_open"))
    longer = (placed.filter(~single).withColumn("_first", first)
              .groupBy("_file", F.col("_first.b").alias("_b"), F.col("_first.l").alias("_l"))
              .agg(F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("_lines"))
              .select("_file", F.col("_b").alias("_block"), F.col("_l").alias("_line"),
                      F.array_join(F.transform("_lines", lambda x: x["value"]), "\n").alias("record")))
    one = placed.filter(single).select(*PLACE, F.col("value").alias("record"))
    cut = F.when(F.col("record").endswith("\r"), F.substring("record", F.lit(1), F.length("record") - 1)).otherwise(F.col("record"))
    return one.unionByName(longer).withColumn("record", cut)


def field_count(record: Column) -> Column:
    """Fields of a record, 0 where it is blank. Quoted parts don't count."""
    bare = F.regexp_replace(record, '"[^"]*+"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.when(F.btrim(record, F.lit(" \t\n\x0b\x0c\r")) == "", 0).otherwise(commas + 1).cast("int")


def fields(record: Column, names: list[str]) -> Column:
    """The named string fields of a record, in a struct; those that it lacks are null."""
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    return F.from_csv(record, schema, {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``records`` of the files at ``path``."""
    return records(lines_of(spark.read, path))
