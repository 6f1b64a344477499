"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard by
hash. In each round a join per group of linked documents finds the shards
where the group is strongest (as many as it needs to fit), and the members
elsewhere move there: a join of documents with their group's shard counts.
Quotas keep the shards from overflowing: a shard takes at most the places
that linked documents leave free and those of the documents that leave it in
the same round, so full shards exchange equal volumes; where more want in,
small groups are let in whole by a hash draw and large ones member by member.
Of equally strong shards another one leads in each round. Documents without a
link follow no neighbour; they make room. Rounds end when no document is
outside the shards of its group, or when ``STALLED`` rounds in a row have not
lowered the number of those that are.

Law ``rows``: shard counts are at most one apart. Surplus rows of a shard,
those without a link first and then small groups one after the other, move to
shards with too few, and slots are numbered without gaps; both come from one position per row within its shard,
numbered by hash buckets so that no shard is numbered in one task.

Defined cases: null text counts as empty text; all empty texts are one group.
Repeated rows are rows of their own (equal ones are linked). Null ids are
placed like any id. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import written

SHARDS, STALLED = 24, 3
#: Rows of a shard that are numbered together, about.
BUCKET_ROWS = 500_000


def _draw(*keys) -> Column:
    """A number in [0, 1) from the keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)


def rows_of(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, g1, g2, draw, shard): a narrow row per document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g1"))
    return (rows.withColumn("g2", F.xxhash64("text_crc32", "size")).withColumn("draw", F.xxhash64("doc_id", F.lit(1)))
            .withColumn("shard", F.pmod("draw", F.lit(shards)).cast("int")))


def _plan(cells: DataFrame, cap: int, shards: int, turn: int = 0) -> DataFrame:
    """(g1, g2, shard, target, n, m): where each group's members outside its home shards want to go."""
    groups = cells.groupBy("g1", "g2").agg(F.collect_list(F.struct("shard", "n")).alias("cells"))  # a cell per shard at most

    def run(batches):
        for batch in batches:
            rows = []
            for g1, g2, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                m = sum(c["n"] for c in cell)
                # Strongest first; equal cells in an order that differs from group to group and turn to turn.
                cell.sort(key=lambda c: (-c["n"], (c["shard"] + (g1 >> turn % 32)) % shards))
                homes = [[c["shard"], max(0, cap - c["n"])] for c in cell[:-(-m // max(cap, 1))]]
                for c in cell[len(homes):]:
                    home = max(homes, key=lambda h: h[1]) if m > cap else homes[0]
                    home[1] -= c["n"]
                    rows.append((g1, g2, c["shard"], home[0], c["n"], m))
            cols = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["g1", "g2", "shard", "target", "n", "m"])
    return groups.mapInArrow(run, "g1 long, g2 long, shard int, target int, n long, m long")


def shares_of(load: dict[int, int], flows: dict[tuple[int, int], int], cap: int) -> dict[int, float]:
    """By target, the greatest shares of the ``flows`` (from, to) that leave no shard above ``cap`` that isn't yet."""
    wanted: dict[int, int] = {}
    for (_, t), n in flows.items():
        wanted[t] = wanted.get(t, 0) + n
    share = dict.fromkeys(wanted, 1.0)
    while True:  # falls from 1 to the greatest fixed point
        out = dict.fromkeys(wanted, 0.0)
        for (s, t), n in flows.items():
            if s in out:
                out[s] += n * share[t]
        new = {t: min(1.0, max(0.0, cap - load.get(t, 0) + out[t]) / n) for t, n in wanted.items()}
        if max((share[t] - new[t] for t in new), default=0) < 1e-6:
            return new
        share = new


def propagate(linked: DataFrame, cap: int, shards: int) -> DataFrame:
    """The linked rows with the shard that the rounds lead to."""
    least, stalled, turn = None, 0, 0
    while True:
        cells = written(linked.groupBy("g1", "g2", "shard").agg(F.count(F.lit(1)).alias("n")), "shard-cells")
        load = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row per shard
        plan = written(_plan(cells, cap, shards, turn), "shard-plan")
        # A row per pair of shards at most.
        flows = {(r["shard"], r["target"]): r["n"] for r in plan.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()}
        outside = sum(flows.values())
        if least is None or outside < least:
            least, stalled = outside, 0
        else:
            stalled += 1
        quota = shares_of(load, flows, cap)
        if not outside or stalled == STALLED:
            break
        turn += 1
        if not any(quota.values()):
            continue
        share = F.element_at(F.create_map(*[x for t, q in quota.items() for x in (F.lit(t), F.lit(q))]), F.col("target"))
        whole = 64 * F.col("m") <= cap
        going = F.when(whole, _draw("g1", "g2", F.lit(turn))).otherwise(_draw("draw", F.lit(turn))) < share
        moves = plan.select("g1", "g2", "shard", "target", "m")
        linked = written(linked.join(moves, ["g1", "g2", "shard"], "left")
                         .withColumn("shard", F.when(F.col("target").isNotNull() & going, F.col("target")).otherwise(F.col("shard")))
                         .drop("target", "m"), "shard-rows")
    return linked


def _positions(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """``rows`` with ``pos``, from 0 within each shard: rows without a link first, then by hash."""
    buckets = max(1, total // shards // BUCKET_ROWS + 1)
    # Small groups stay together, so that those that move do so whole.
    placed = rows.withColumn("key", F.when(F.col("small"), F.xxhash64("g1", "g2", F.lit(2))).otherwise(F.col("draw")))
    placed = placed.withColumn("bucket", F.col("linked").cast("int") * buckets + F.floor(F.pmod("key", F.lit(1 << 40)) / float(1 << 40) * buckets).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")  # shards x buckets rows
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "g1", "g2", "draw", "doc_id")
    return (placed.withColumn("local", F.row_number().over(inside)).join(offsets, ["shard", "bucket"])
            .withColumn("pos", F.col("local") - 1 + F.col("off")))


def _lookup(values: dict[int, int], key: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))]), key)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``."""
    rows = written(rows_of(docs, shards), "shard-rows")
    total = rows.count()
    cap = -(-total // shards)
    groups = rows.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("g1", "g2", F.lit(True).alias("linked"), (64 * F.col("members") <= cap).alias("small"))
    rows = rows.join(groups, ["g1", "g2"], "left")
    rows = written(rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("linked", "small")}), "shard-rows")
    linked = propagate(rows.filter("linked"), cap, shards)
    rows = written(linked.select(*rows.columns).unionByName(rows.filter("not linked")), "shard-rows")

    have = {s: 0 for s in range(shards)} | {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_size = sorted(have, key=lambda s: (-have[s], s))
    due = {s: total // shards + (i < total % shards) for i, s in enumerate(by_size)}
    surplus = {s: max(0, have[s] - due[s]) for s in have}
    giver_from, index = {}, 0
    for s in have:
        giver_from[s], index = index, index + surplus[s]
    takers, index = [], 0  # (first index of those who move, shard, first slot)
    for s in have:
        if have[s] < due[s]:
            takers.append((index, s, have[s]))
            index += due[s] - have[s]
    moving = F.col("pos") < _lookup(surplus, F.col("shard"))
    nth = _lookup(giver_from, F.col("shard")) + F.col("pos")
    to, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for first, s, at in takers:
        to = F.when(nth >= first, F.lit(s)).otherwise(to)
        slot = F.when(nth >= first, nth - first + at).otherwise(slot)
    done = _positions(rows, total, shards).select("doc_id", "size", "text_crc32", "shard", "pos")
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.when(moving, to).otherwise(F.col("shard")).alias("shard"),
                       F.when(moving, slot).otherwise(F.col("pos") - _lookup(surplus, F.col("shard"))).cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
