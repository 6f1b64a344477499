"""Audits of input, topic tables and the chunk index (A1-A8, J2-J4, W3,
L1, L3, L5, X1-X3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topicspark.functions.text import strip_ws
from topicspark.operators.numbering import number_rows, number_rows_nested, running_offsets
from topicspark.session import checkpoint_dir


def row_count(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def rows_per_topic(df: DataFrame) -> DataFrame:
    """A2: (topic, n_rows) most rows first."""
    return (df.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))
              .orderBy(F.desc("n_rows"), "topic"))


def distinct_topics(df: DataFrame) -> DataFrame:
    """A3."""
    return df.agg(F.countDistinct("topic").alias("n_topics"))


def null_row_positions(df: DataFrame, order: list[str], cols: list[str]) -> DataFrame:
    """A5: 0-based positions (in ``order``) of rows with a null in ``cols``;
    one row per such row (the count is the row count of the result)."""
    from topicspark.operators.prepare import any_null, with_row_index
    return with_row_index(df, order, "index").filter(any_null(df, cols)).select("index")


def chunks_per_topic(ci: DataFrame) -> DataFrame:
    """A6."""
    return ci.groupBy("topic").agg(F.count(F.lit(1)).alias("n_chunks"))


def rows_covered(ci: DataFrame) -> DataFrame:
    """Sum of abs(end - start) + 1 per topic."""
    return ci.groupBy("topic").agg(
        F.sum(F.abs(F.col("chunkEnd") - F.col("chunkStart")) + 1).cast("long").alias("n_rows"))


def index_summary(ci: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: total chunks, covered rows, actual / expected / missing topics."""
    a = ci.agg(F.count(F.lit(1)).alias("n_chunks"),
               F.coalesce(F.sum(F.abs(F.col("chunkEnd") - F.col("chunkStart")) + 1), F.lit(0))
               .cast("long").alias("n_rows"),
               F.countDistinct("topic").alias("actual_topics"))
    e = expected.agg(F.countDistinct("topic").alias("expected_topics"))
    m = missing_topics(expected, ci).agg(F.count(F.lit(1)).alias("missing_topics"))
    return a.crossJoin(e).crossJoin(m)  # three one-row frames


def missing_topics(expected: DataFrame, ci: DataFrame) -> DataFrame:
    """Expected topics with no chunk (anti join)."""
    return expected.select("topic").distinct().join(ci.select("topic"), "topic", "left_anti")


def topic_counts(expected: DataFrame, rows: DataFrame) -> DataFrame:
    """Every listed topic with its row count, 0 where it has none."""
    counts = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))
    return (expected.select("topic").distinct().join(counts, "topic", "left")
                    .select("topic", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")))


#: Positions per block of a positional compare.
COMPARE_BLOCK = 100_000


def _prints(df: DataFrame, outer: list[str], order: list[str], col: str) -> DataFrame:
    """(idx, _key, _p, _q): position, order keys and 128 print bits of the
    trimmed value of each row, checkpointed. The value itself goes nowhere."""
    v = strip_ws(col)
    keys = [*outer, *order]
    narrow = df.select(*keys, *[F.xxhash64(F.lit(salt), v.isNull(), v).alias(name) for salt, name in ((1, "_p"), (2, "_q"))])
    numbered = number_rows_nested(narrow, outer, order, "idx") if outer else number_rows(narrow, [], order, "idx")
    return numbered.select("idx", F.struct(*keys).alias("_key"), "_p", "_q").checkpoint(eager=True)


def _block_prints(prints: DataFrame, names: list[str]) -> DataFrame:
    """(block, names...): print of each block, in which every row counts with its position."""
    row = [F.xxhash64(F.lit(salt), "idx", "_p", "_q") for salt in (1, 2)]
    return prints.groupBy(F.floor((F.col("idx") - 1) / F.lit(COMPARE_BLOCK)).alias("block")).agg(
        *[F.bit_xor(h).alias(n) for h, n in zip(row, names)])


def _at(df: DataFrame, key: Row, col: str, p: int, q: int) -> DataFrame:
    """The value at one key, by literal filters; where rows share the key, the one with this print."""
    v = strip_ws(col)
    for name, value in key.asDict().items():
        df = df.filter(F.col(name).eqNullSafe(F.lit(value)))
    return df.filter((F.xxhash64(F.lit(1), v.isNull(), v) == p) & (F.xxhash64(F.lit(2), v.isNull(), v) == q)).limit(1)


def first_mismatch(a: DataFrame, a_order: list[str], b: DataFrame, b_order: list[str],
                   col: str = "question", a_outer: list[str] | None = None,
                   b_outer: list[str] | None = None) -> DataFrame:
    """First position where trimmed ``col`` differs between two tables
    compared row by row in their orders ((outer keys, order keys) each);
    rows beyond the shorter side are ignored. Empty when they agree.

    Each side is read once for narrow prints of its values. Blocks of
    positions are compared by one print each (a row per ``COMPARE_BLOCK``
    positions), rows only in the first block that differs, and the two values
    are read by their keys. End the orders with a unique key: rows that agree
    in all of it come in any order. Values count as equal when 128 hash bits
    agree."""
    spark = a.sparkSession
    checkpoint_dir(spark)
    ap, bp = _prints(a, a_outer or [], a_order, col), _prints(b, b_outer or [], b_order, col)
    shorter = F.col("idx") <= min(ap.count(), bp.count())
    ap, bp = ap.filter(shorter), bp.filter(shorter)
    unlike = (_block_prints(ap, ["_p1", "_q1"]).join(_block_prints(bp, ["_p2", "_q2"]), "block")
              .filter("_p1 <> _p2 or _q1 <> _q2").agg(F.min("block").alias("block")).first()["block"])
    value = a.schema[col].dataType
    if unlike is None:
        return spark.createDataFrame([], StructType().add("index", "long").add("left_value", value).add("right_value", value))
    block = F.col("idx").between(unlike * COMPARE_BLOCK + 1, (unlike + 1) * COMPARE_BLOCK)
    hit = (ap.filter(block).alias("l").join(bp.filter(block).alias("r"), "idx")
             .filter("l._p <> r._p or l._q <> r._q").orderBy("idx").limit(1)
             .select("idx", *[F.col(f"{t}.{c}").alias(f"{t}{c}") for t in "lr" for c in ("_key", "_p", "_q")]).first())
    index = F.lit(hit["idx"] - 1).cast("long").alias("index")
    left, right = (_at(df, hit[f"{t}_key"], col, hit[f"{t}_p"], hit[f"{t}_q"]).select(index, F.col(col).alias(name))
                   for df, t, name in ((a, "l", "left_value"), (b, "r", "right_value")))
    both = left.unionByName(right, allowMissingColumns=True)  # a row each
    return both.groupBy("index").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("left_value", "right_value")])


def chunk_gaps(ci: DataFrame) -> DataFrame:
    """(topic, chunk_end, next_start) where a topic's next chunk (in
    chunkStart order) does not start right after the previous one ends.

    Chunks are ranged by (topic, chunkStart, chunkEnd) over borders sampled
    from all of them, so a topic with very many chunks is many tasks. Within a
    range the next chunk is a ``lead``; the last chunk of a range takes its
    successor from a table of the ranges' first chunks (one row per range)."""
    spark = ci.sparkSession
    checkpoint_dir(spark)
    key = ["topic", "chunkStart", "chunkEnd"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (ci.select(*key).repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in key]).checkpoint(eager=True)
                .withColumn("_range", F.spark_partition_id()))
    after = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in key])
    here = F.struct(F.col("topic").alias("topic"), F.col("chunkStart").alias("start"))
    # Ranges without rows have no first chunk, so the next one that has is the successor.
    firsts = ranged.groupBy("_range").agg(F.min_by(here, F.struct(*key)).alias("_first"))
    borders = firsts.select("_range", F.lead("_first").over(Window.orderBy("_range")).alias("_border"))
    found = (ranged.withColumn("_next", F.lead(here).over(after)).join(F.broadcast(borders), "_range")  # a row per range
             .withColumn("_next", F.coalesce("_next", "_border")))
    return (found.filter(F.col("_next.topic").eqNullSafe(F.col("topic")) & (F.col("_next.start") != F.col("chunkEnd") + 1))
                 .select("topic", F.col("chunkEnd").alias("chunk_end"), F.col("_next.start").alias("next_start")))


def _ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key..., before, same): for each distinct tuple, the rows that stand
    before it in ascending order, and the rows that hold it."""
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("same"))
    return running_offsets(counts, [F.col(k).asc() for k in key], "same", "before")


def topics_by_ranges(ci: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """L4: topics ordered by their list of (chunkStart, chunkEnd) pairs
    (ascending within a topic), descending; lists compare element by element
    and a proper prefix is smaller. Output (topic, position, n_rows), ties by
    topic name.

    Exact without gathering a topic's list into one group: prefix doubling.
    Every element (topic, i) starts with the rank of its pair (elements with a
    smaller pair, plus 1); each round splits the elements of one rank by the
    rank at i + k, the end of a list ranking below everything. An element
    whose rank no other holds is settled: it is looked up by others but is
    not ranked again, as what a split gives stays within the places of its
    rank. The rounds end when every list's first element is settled, or its
    whole list is compared. Each round is an equi-join on the unique key
    (topic, i) and a distributed running count over the active elements, which
    are checkpointed. ``rounds`` takes the number of elements that each round
    ranks."""
    checkpoint_dir(ci.sparkSession)
    el = number_rows(ci.select("topic", "chunkStart", "chunkEnd"), ["topic"],
                     ["chunkStart", "chunkEnd"], "i")
    pair = ["chunkStart", "chunkEnd"]
    cur = el.join(_ranked(el, pair), pair).select(
        "topic", "i", (F.col("before") + 1).alias("r"), (F.col("same") == 1).alias("settled")).checkpoint(eager=True)
    longest = cur.agg(F.max("i")).first()[0] or 0
    done, active, k = cur.filter("settled"), cur.filter("NOT settled"), 1
    while k < longest:
        size = active.agg(F.count(F.lit(1)), F.min("i")).first()
        if rounds is not None:
            rounds.append(size[0])
        if size[1] != 1:  # every list's first element is settled
            break
        ahead = done.unionByName(active).select("topic", (F.col("i") - k).alias("i"), F.col("r").alias("r2"))
        paired = active.join(ahead, ["topic", "i"], "left").select("topic", "i", "r", F.coalesce("r2", F.lit(0)).alias("r2"))
        split = _ranked(paired, ["r", "r2"]).checkpoint(eager=True)
        least = split.groupBy("r").agg(F.min("before").alias("least"))
        cur = (paired.join(split, ["r", "r2"]).join(least, "r")
                     .select("topic", "i", (F.col("r") + F.col("before") - F.col("least")).alias("r"),
                             (F.col("same") == 1).alias("settled")).checkpoint(eager=True))
        done, active, k = done.unionByName(cur.filter("settled")), cur.filter("NOT settled"), 2 * k
    first = done.unionByName(active).filter(F.col("i") == 1).select("topic", "r")
    rows = ci.groupBy("topic").agg(
        F.sum(F.abs(F.col("chunkEnd") - F.col("chunkStart")) + 1).cast("long").alias("n_rows"))
    order = first.join(rows, "topic").withColumn("_one", F.lit(1))
    ranked = running_offsets(order, [F.col("r").desc(), F.col("topic").asc()], "_one", "_before")
    return ranked.select("topic", (F.col("_before") + 1).alias("position"), "n_rows")


def page(df: DataFrame, k: int, n: int, order: list[str]) -> DataFrame:
    """L1: page ``k`` (0-based) of ``n`` rows in ``order``."""
    return df.orderBy(*order).offset(k * n).limit(n)


def most_recent_chunks(ci: DataFrame, n: int = 3) -> DataFrame:
    """L3: the ``n`` most recently updated chunks (latest id first on ties)."""
    return ci.orderBy(F.desc("updatedAt"), F.desc("id")).limit(n)


def chunk_head_tail(rows: DataFrame, n: int, chunk_cols: list[str], order: str = "id") -> DataFrame:
    """First and last ``n`` rows of every chunk (groups are bounded by
    the chunk size)."""
    w_head = Window.partitionBy(*chunk_cols).orderBy(F.col(order))
    w_tail = Window.partitionBy(*chunk_cols).orderBy(F.col(order).desc())
    r = rows.withColumn("_h", F.row_number().over(w_head)).withColumn("_t", F.row_number().over(w_tail))
    return (r.filter((F.col("_h") <= n) | (F.col("_t") <= n))
             .withColumn("part", F.when(F.col("_h") <= n, F.lit("head")).otherwise(F.lit("tail")))
             .drop("_h", "_t"))


def distinct_topic_rows(df: DataFrame) -> DataFrame:
    """X1."""
    return df.select("topic").distinct()


def topics_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected minus actual topics (set semantics)."""
    return expected.select("topic").subtract(actual.select("topic"))


def append_batches(*batches: DataFrame) -> DataFrame:
    """Append of batches by column name."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out
