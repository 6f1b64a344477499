"""Batch ingest: S1 -> P9 -> P8/P12 -> W2 -> S8, with the load report.

All topics load in one job; the only wide steps are the id numbering and
the clustering before the partitioned write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicspark.operators.prepare import to_node_rows, validate
from topicspark.operators.sizing import bounded_broadcast
from topicspark.session import checkpoint_dir
from topicspark.sources import csv_io, csv_records, store


@dataclass
class LoadResult:
    rows: DataFrame      # node rows with ids (topic, id, question, answer, keywords, updatedAt)
    rejects: DataFrame   # input rows with reject_reason
    report: DataFrame    # A12: per topic loaded / rejected counts


def prepare_load(inp: DataFrame, existing: DataFrame | None, as_of: str,
                 order: list[str], base: DataFrame | None = None,
                 base_checked: bool = False) -> LoadResult:
    """Plan a load of ``inp`` (question, answer, topic, + order columns).

    ``order`` names the input-order columns (e.g. file name and position).
    The id base is ``base`` (topic, max_id) when given, else the max ids of
    ``existing`` (the current article table), else 0.
    """
    v = validate(inp)
    good = v.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = v.filter(F.col("reject_reason").isNotNull())
    nodes = to_node_rows(good, as_of)
    with_ids = store.allocate_ids(nodes, existing, order, base=base, base_checked=base_checked)
    rows = with_ids.select("topic", "id", "question", "answer", "keywords", "updatedAt")
    report = load_report(v)
    return LoadResult(rows, rejects, report)


def load_report(validated: DataFrame) -> DataFrame:
    """Rows of one load per topic (ascending), with rejected counts."""
    return (validated.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("reject_reason").isNull()).alias("loaded"),
                 F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))
            .orderBy(F.col("topic").asc_nulls_first()))


def ingest(inp: DataFrame, path: str, as_of: str, order: list[str], load: str | None = None) -> LoadResult:
    """Load ``inp`` into the article table at ``path`` (append).

    The id base comes from the table's id log (one row per topic), so a load
    costs its own rows plus one row per topic; only when there is no log yet
    are the max ids read from the article table. Ids are reserved before the
    rows are appended. With a ``load`` name a failed load can be repeated: it
    gets the same ids and replaces what it had written."""
    spark = inp.sparkSession
    checkpoint_dir(spark)
    counts = (validate(inp).filter(F.col("reject_reason").isNull())
              .groupBy("topic").agg(F.count(F.lit(1)).alias("n")))
    base = bounded_broadcast(store.reserve_ids(spark, path, counts, load))
    res = prepare_load(inp, None, as_of, order, base=base, base_checked=True)
    store.append_articles(res.rows, path, load=load)
    return res


def ingest_csv(spark, csv_path: str, table: str, as_of: str, load: str | None = None) -> LoadResult:
    """The original's load: headerless (question, answer, topic) CSV files,
    every row routed to its topic's partition with ids continuing the
    topic's max id in file order; bad records are returned as rejects."""
    return ingest(csv_io.read_input_csv(spark, csv_path, with_place=True), table, as_of, csv_records.PLACE, load)
