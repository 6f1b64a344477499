"""Skew-safe dense row numbering (W1, W2, P14, J4 and the fixtures).

``row_number() OVER (PARTITION BY topic ORDER BY id)`` puts every row of a
topic into one task; a topic holding a third of the table would be one task.
A larger table is numbered on its keys alone instead:

1. the distinct (group, order key) tuples with their counts; a range
   partitioning over *all* of them, whose borders are quantiles that Spark
   samples from the tuples, gives buckets of about ``target_rows``, whatever
   the keys are: one file or topic, fractions, clusters, text;
2. the ranged tuples are checkpointed, so that borders and bucket numbers
   stay the same for every later use, also after a lost executor;
3. first position of a tuple in its group = rows of the group in earlier
   buckets (prefix sums over a table of a row per group and bucket) + rows
   of the group before it in its bucket (a window over that);
4. the wide rows meet their positions last, in one join on the keys.

The table of groups and buckets is broadcast only when its counted rows are
under ``MAX_BROADCAST_ROWS``; beyond it it is joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicspark.session import checkpoint_dir

MAX_BROADCAST_ROWS = 2_000_000
TARGET_ROWS = 2_000_000
#: A table of so many rows is numbered by one window.
DIRECT_ROWS = 200_000


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def number_rows(df: DataFrame, by: list[str], order: list[Column | str],
                name: str = "rn", descending: list[bool] | None = None,
                target_rows: int = TARGET_ROWS, bucket_col: str | None = None) -> DataFrame:
    """Add ``name`` = 1-based position (long) of each row within its ``by``
    group in ``order``: ascending with nulls first, or descending with nulls
    last where ``descending`` says so. End ``order`` with a unique key so
    that the order is total; rows that agree in all of it get consecutive
    positions in any order. ``bucket_col`` keeps the bucket of each row under
    that name.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    down = descending or [False] * len(order_cols)
    keys = [f"_ts_g{i}" for i in range(len(by))]
    okeys = [f"_ts_o{i}" for i in range(len(order_cols))]
    base = df.select("*", *[F.col(c).alias(k) for c, k in zip(by, keys)],
                     *[c.alias(k) for c, k in zip(order_cols, okeys)])
    sorts = [F.col(k).desc_nulls_last() if d else F.col(k).asc_nulls_first() for k, d in zip(okeys, down)]
    rows = base.select(*keys, *okeys).count()
    if rows <= min(target_rows, DIRECT_ROWS):
        at = F.row_number().over(Window.partitionBy(*keys).orderBy(*sorts)).cast("long").alias(name)
        return base.select(*df.columns, at, *([F.lit(0).cast("long").alias(bucket_col)] if bucket_col else []))

    checkpoint_dir(df.sparkSession)
    ranged = (base.groupBy(*keys, *okeys).agg(F.count(F.lit(1)).alias("_ts_c"))
              .repartitionByRange(-(-rows // target_rows), *[F.col(k).asc_nulls_first() for k in keys], *sorts)
              .checkpoint(eager=True).withColumn("_ts_b", F.spark_partition_id().cast("long")))
    sums = ranged.groupBy(*keys, "_ts_b").agg(F.sum("_ts_c").alias("_ts_n"), F.max("_ts_c").alias("_ts_same")).checkpoint(eager=True)
    size = sums.agg(F.count(F.lit(1)).alias("n"), F.max("_ts_same").alias("same")).first()
    earlier = Window.partitionBy(*keys).orderBy("_ts_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(k).alias(k + "s") for k in keys], F.col("_ts_b").alias("_ts_bs"),
                          F.coalesce(F.sum("_ts_n").over(earlier), F.lit(0)).alias("_ts_off"))
    before = Window.partitionBy(*keys, "_ts_b").orderBy(*sorts).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("_ts_in", F.coalesce(F.sum("_ts_c").over(before), F.lit(0)))
              .join(_maybe_broadcast(offsets, size["n"]),
                    _same(keys, "s") + [F.col("_ts_b") == F.col("_ts_bs")])
              .select(*[F.col(k).alias(k + "p") for k in keys + okeys], "_ts_b",
                      (F.col("_ts_off") + F.col("_ts_in") + 1).alias("_ts_first")))
    # Neither side is small here, whatever the planner makes of a file's size: a
    # broadcast would send the whole table through the driver.
    out = base.hint("merge").join(placed.hint("merge"), _same(keys + okeys, "p"))
    if size["same"] > 1:
        alike = Window.partitionBy(*keys, *okeys).orderBy(F.lit(0))
        out = out.withColumn("_ts_first", F.col("_ts_first") + F.row_number().over(alike) - 1)
    return out.select(*df.columns, F.col("_ts_first").cast("long").alias(name),
                      *([F.col("_ts_b").alias(bucket_col)] if bucket_col else []))


def _same(columns: list[str], suffix: str) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(k + suffix)) for k in columns]


def number_rows_nested(df: DataFrame, outer: list[str], order: list[Column | str],
                       name: str = "rn") -> DataFrame:
    """Global 1-based position in the order (``outer`` keys, then ``order``),
    for outer keys of any type (e.g. topic names): positions within each
    outer group come from ``number_rows``; a group's offset is the row count
    of the groups before it, from a table with one row per group."""
    local = number_rows(df, outer, order, "_ts_local")
    counts = df.groupBy(*outer).agg(F.count(F.lit(1)).alias("_ts_n"))
    okeys = [f"_ts_x{i}" for i in range(len(outer))]
    offs = running_offsets(counts, [F.col(c).asc_nulls_first() for c in outer], "_ts_n", "_ts_goff")
    offs = offs.select(*[F.col(c).alias(k) for c, k in zip(outer, okeys)], "_ts_goff")
    n_groups = offs.count()
    cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(outer, okeys)]
    out = local.join(_maybe_broadcast(offs, n_groups), cond, "inner")
    return out.select(*df.columns, (F.col("_ts_goff") + F.col("_ts_local")).cast("long").alias(name))


def dense_rank_values(df: DataFrame, cols: list[str], name: str = "dr") -> DataFrame:
    """Add ``name`` = dense rank (1-based) of the value tuple ``cols`` over the
    whole table, ascending. Distinct values
    are numbered by ``number_rows`` and joined back (broadcast when their
    counted number allows; a hot value is then no problem)."""
    distinct = df.select(*cols).distinct()
    ranked = number_rows(distinct, [], cols, name)
    ranked = ranked.checkpoint(eager=True)
    n = ranked.count()
    keys = [f"_ts_v{i}" for i in range(len(cols))]
    rk = ranked.select(*[F.col(c).alias(k) for c, k in zip(cols, keys)], name)
    cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(cols, keys)]
    return df.join(_maybe_broadcast(rk, n), cond, "inner").drop(*keys)


def running_offsets(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows before each row in
    ``order`` (a total order), without putting the table in one task.

    The table is range-partitioned on ``order`` and checkpointed (so its
    partition ids are fixed); each partition's total comes from an aggregate
    with one row per partition, prefix sums of those totals are a
    partition-count-sized table, and the sum within a partition is a window
    over that partition only."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).checkpoint(eager=True)
    tagged = ranged.withColumn("_ts_pid", F.spark_partition_id())
    totals = tagged.groupBy("_ts_pid").agg(F.sum(value).alias("_ts_ps"))
    part_off = totals.select("_ts_pid", F.coalesce(F.sum("_ts_ps").over(
        Window.orderBy("_ts_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ts_poff"))
    within = Window.partitionBy("_ts_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # part_off has one row per partition (a configuration-sized bound).
    out = (tagged.withColumn("_ts_in", F.coalesce(F.sum(value).over(within), F.lit(0)))
                 .join(F.broadcast(part_off), "_ts_pid"))
    return out.select(*df.columns, (F.col("_ts_poff") + F.col("_ts_in")).cast("long").alias(name))
