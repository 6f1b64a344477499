"""ST1: chunked ingest as a Structured Streaming job.

``readStream`` over a folder of headerless input CSV files, a bounded
number of files per micro-batch, ``foreachBatch`` running the batch ingest
plan, progress kept in a checkpoint. A batch is a load like any other: it
takes its ids from the table's one id log, under the stream's name and the
batch number, and writes the partitions of that load. A replayed batch finds
its own reservation, so it gets the same ids and replaces its own rows; no
batch scans the table, and batch loads and other streams may write to the
table before, between and after.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicspark.operators.prepare import to_node_rows, validate
from topicspark.operators.sizing import bounded_broadcast
from topicspark.session import checkpoint_dir
from topicspark.sources import csv_io, csv_records, id_log, store


def input_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """The lines of the folder's files; a file may be cut into byte ranges."""
    return csv_records.lines_of(spark.readStream.option("maxFilesPerTrigger", files_per_batch), folder)


def rejects_path(table: str) -> str:
    """Rejected records of every batch, with their reason, by ``load``."""
    return table.rstrip("/") + "_rejects"


def stream_name(checkpoint: str) -> str:
    """The name under which the stream of a checkpoint reserves ids."""
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _batch_writer(table: str, as_of: str, name: str):
    """foreachBatch body: rejects, reservation, rows, all under the batch's
    load, so that each of them is the same when the batch comes again."""
    def write(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        load = f"{name}-{batch_id}"
        checkpoint_dir(spark)
        v = validate(csv_io.parse_input(csv_records.records(lines))).checkpoint()  # read several times below
        (v.filter(F.col("reject_reason").isNotNull()).select("question", "answer", "topic", "reject_reason")
          .withColumn("load", F.lit(load)).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(rejects_path(table)))
        good = v.filter(F.col("reject_reason").isNull()).drop("reject_reason")
        counts = good.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
        base = bounded_broadcast(store.reserve_ids(spark, table, counts, name, batch_id))
        rows = store.allocate_ids(to_node_rows(good, as_of), None, csv_records.PLACE, base=base, base_checked=True)
        store.append_articles(rows, table, load=load)
    return write


def run_ingest_stream(spark: SparkSession, folder: str, table: str, checkpoint: str,
                      as_of: str, files_per_batch: int = 1) -> None:
    """Ingest every file now in ``folder`` (availableNow) and stop.

    Batch numbers start again with a new checkpoint. Where the table knows
    loads of this checkpoint's name but the checkpoint is gone, a new one in
    its place would take their ids and replace their rows, and is refused."""
    name = stream_name(checkpoint)
    if not _exists(spark, checkpoint) and name in id_log.named_loads(spark, table):
        raise ValueError(f"the checkpoint of a stream into {table} is gone: take a new folder for the next one")
    q = (input_stream(spark, folder, files_per_batch).writeStream
         .foreachBatch(_batch_writer(table, as_of, name))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    return store.read_articles(spark, table)


def stream_paths(base: str) -> tuple[str, str, str]:
    return (os.path.join(base, "in"), os.path.join(base, "table"), os.path.join(base, "ckpt"))
