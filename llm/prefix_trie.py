"""Conversation prefix trie by ROLLUP over positional turn columns.

Conversations become sequences of turn ids. A block row holds ``BLOCK``
consecutive ones in columns t0, t1, ..., with the node that the sequence has
reached before them (``prior``). ``GROUP BY depth0, prior, ROLLUP (t0, ...)``
aggregates all prefixes together, grouping_id tells a prefix's length, and a
conversation of more turns continues in a further block keyed by the prior
block's node. A second ROLLUP, over the nodes themselves, sums each subtree of a
block; what hangs below a block's last level is added to that level first, by
pointer doubling over the blocks of long conversations (log2 of their number of
blocks in rounds, none where no conversation has more than two blocks).

Node ids are 16 bytes of SHA-256 over (prior, turn ids), turn ids 16 bytes of
SHA-256 over role and text. A conversation's turns pass through one task in
order (external sort, then a pass that holds one block), so a conversation of
any length needs bounded memory. Shared first turns and copies meet in partial
aggregates. The ids that end at a node are joined in sorted runs of bounded
size by tasks over ranges of (node, id); one task per node only hashes these.

Rebuilding (``rebuilt``): conversation c is the first h turns of conversation
c - c % 100 (all if fewer, none if absent), then its own turns after its first
h; h = crc32(decimal c) % 6.

Defined cases: null turns come first; equal turn numbers go by turn id, so
that their order doesn't depend on the file; null roles and texts are empty;
repeated rows are turns of their own; rows without a conv_id belong to no
conversation and are left out; a turnless rebuilt conversation is a member of
the root; an empty table gives no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import partitions, releasing, written

SPREAD, HEADS = 100, 6
BLOCK = 8
ROOT = bytes(16)
#: Conversation ids that a run of joined ids holds at most; rows of a batch that a task hands on.
RUN, HANDED = 50_000, 2000

TURNS = [f"t{i}" for i in range(BLOCK)]
_TURN = pa.struct([("id", pa.binary()), ("chars", pa.int64())])
_BLOCKS = pa.schema([("conv_id", pa.int64()), ("depth0", pa.int64()), ("prior", pa.binary()), ("n", pa.int32()),
                     ("ended", pa.bool_()), *[(t, _TURN) for t in TURNS]])
BLOCKS = ("conv_id long, depth0 long, prior binary, n int, ended boolean, "
          + ", ".join(f"{t} struct<id: binary, chars: bigint>" for t in TURNS))


def _short(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, chars) of every row with a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.filter("conv_id IS NOT NULL")
            .select("conv_id", "turn", _short(named.cast("binary")).alias("id"), F.length(text).cast("long").alias("chars")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, own, turn, id, chars, skip): for each conversation the turns taken from its base (``own`` 0), then
    all its own turns (1), of which the first ``skip`` don't count."""
    base = F.col("conv_id") - F.col("conv_id") % SPREAD
    skip = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"))
    from pyspark.sql import Window
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    heads = (turns.filter(F.col("conv_id") == base).withColumn("at", F.row_number().over(order)).filter(F.col("at") < HEADS)
             .select(F.col("conv_id").alias("base"), "at", "id", "chars"))
    taken = (ids.select("conv_id", base.alias("base"), skip.alias("skip")).join(heads, "base").filter("at <= skip")
             .select("conv_id", F.lit(0).alias("own"), F.col("at").cast("long").alias("turn"), "id", "chars", "skip"))
    return taken.unionByName(turns.withColumn("own", F.lit(1)).withColumn("skip", skip))


def _cut(batches):
    """Block rows of sequences that come in order."""
    out, cells = [], []
    conv = prior = skipped = depth = None

    def closed(ended):
        nonlocal prior, depth, cells
        out.append((conv, depth, prior, len(cells), ended, *cells, *[None] * (BLOCK - len(cells))))
        prior = hashlib.sha256(prior + b"".join(c["id"] for c in cells)).digest()[:16]
        depth, cells = depth + len(cells), []

    def sent():
        nonlocal out
        rows, out = out, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCKS, strict=True)],
                                          schema=_BLOCKS)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "own", "skip", "id", "chars")]
        for c, own, skip, turn, chars in zip(*columns, strict=True):
            if c != conv:
                if conv is not None:
                    closed(True)
                conv, prior, skipped, depth = c, ROOT, 0, 0
            if own and skipped < skip:
                skipped += 1
                continue
            if len(cells) == BLOCK:  # only now: a sequence that ends with a full block has no empty one after it
                closed(False)
            cells.append({"id": turn, "chars": chars})
            if len(out) >= HANDED:
                yield sent()
    if conv is not None:
        closed(True)
    if out:
        yield sent()


def blocks(sequences: DataFrame) -> DataFrame:
    """Block rows of ``rebuilt`` sequences, in the columns of ``BLOCKS``."""
    placed = (sequences.repartition(partitions(sequences.sparkSession), "conv_id")
              .sortWithinPartitions("conv_id", "own", F.col("turn").asc_nulls_first(), "id"))
    return placed.select("conv_id", "own", "skip", "id", "chars").mapInArrow(releasing(_cut), BLOCKS)


def _node(level: Column, columns: list[str]) -> Column:
    """Id of the node at the end of the first ``level`` turns of a block."""
    parts = [F.when(level > i, F.col(t)["id"]).otherwise(F.lit(b"")) for i, t in enumerate(columns)]
    return F.when(level == 0, F.col("prior")).otherwise(_short(F.concat(F.col("prior"), *parts)))


def _rolled(table: DataFrame, aggregates: str) -> DataFrame:
    """The aggregates of every prefix, with its ``level`` in the block: only prefixes that the table holds."""
    rolled = table.sparkSession.sql(
        f"SELECT depth0, prior, {', '.join(TURNS)}, {BLOCK} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{table}} GROUP BY depth0, prior, ROLLUP ({', '.join(TURNS)})", table=table)
    # A shorter sequence also makes groups of the levels beyond its end, with a null last turn.
    ends = F.coalesce(*[F.when(F.col("level") == i + 1, F.col(t).isNotNull()) for i, t in enumerate(TURNS)])
    return rolled.filter(F.when(F.col("level") == 0, F.col("depth0") == 0).otherwise(ends))


def _nodes(cut: DataFrame) -> DataFrame:
    level = F.col("level")
    rolled = _rolled(cut, "count(*) AS n_convs, min(conv_id) AS conv_id")
    chars = F.coalesce(*[F.col(t)["chars"] for t in reversed(TURNS)], F.lit(0))
    return written(rolled.select(
        "depth0", "prior", "level", *TURNS, "conv_id", "n_convs", (F.col("depth0") + level).alias("depth"),
        _node(level, TURNS).alias("id"), F.when(F.col("depth0") + level > 0, _node(level - 1, TURNS)).alias("parent"),
        ((F.col("n_convs") - 1) * chars).alias("saved")), "trie-nodes")


def _below(nodes: DataFrame) -> DataFrame | None:
    """(id, saved, leaves) of all that hangs below a block's last level, or None where no block continues."""
    deep = nodes.filter("depth0 > 0")
    deepest = deep.agg(F.max("depth0")).first()[0]
    if deepest is None:
        return None
    up = nodes.filter(f"level = {BLOCK} AND depth0 > 0").select(F.col("id").alias("block"), F.col("prior").alias("up"))
    sums = deep.groupBy(F.col("prior").alias("block")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    state, reach = written(sums.join(up, "block", "left"), "trie-blocks"), BLOCK
    while reach < deepest:
        # ``up`` is the block ``reach`` turns above: its sums take those of all that points to it, and pointers double.
        given = (state.filter("up IS NOT NULL").groupBy(F.col("up").alias("block"))
                 .agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves")))
        further = state.select(F.col("block").alias("up"), F.col("up").alias("up2"))
        state = written(state.join(given, "block", "left").join(further, "up", "left").select(
            "block", (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), F.col("up2").alias("up")), "trie-blocks")
        reach *= 2
    return state.select(F.col("block").alias("id"), F.col("saved").alias("more"), F.col("leaves").alias("more_leaves"))


_RUNS = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
_ENDS = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])


def _joined(batches):
    """Runs of joined conversation ids, of at most ``RUN`` ids each; rows come in order of (id, conv_id)."""
    out, node, run = [], None, []

    def sent():
        nonlocal out
        rows, out = out, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RUNS, strict=True)],
                                          schema=_RUNS)

    def closed():
        nonlocal run
        if run:
            out.append((node, run[0], ",".join(map(str, run))))
            run = []

    for batch in batches:
        for x, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if x != node or len(run) == RUN:
                closed()
                node = x
                if len(out) >= HANDED or len(out) and len(out[-1][2]) > 1 << 16:
                    yield sent()
            run.append(conv)
    closed()
    if out:
        yield sent()


def _hashed(batches):
    """The hash of each node's runs, which come in order of (id, first)."""
    node, state, done = None, None, []
    for batch in batches:
        for x, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if x != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = x, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= HANDED:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=_ENDS)
            done = []
    if node is not None:
        done.append((node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=_ENDS)


def _ends(cut: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the nodes at which conversations end."""
    n = partitions(cut.sparkSession)
    last = cut.filter("ended").select(_node(F.col("n"), TURNS).alias("id"), "conv_id")
    runs = (last.repartitionByRange(n, "id", "conv_id").sortWithinPartitions("id", "conv_id")
            .mapInArrow(_joined, "id binary, first long, ids string"))
    return (runs.repartition(n, "id").sortWithinPartitions("id", "first")
            .mapInArrow(_hashed, "id binary, ends_sha256 string"))


def trie(sequences: DataFrame) -> DataFrame:
    """A row per node of the trie of ``sequences`` (the columns of ``rebuilt``)."""
    cut = written(blocks(sequences), "trie-cut")
    nodes = _nodes(cut)
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    known = written(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                    .withColumn("leaf", (F.col("n_children") == 0).cast("long")), "trie-known")
    below = _below(known)
    summed = known.select("depth0", "prior", "id", *TURNS, "saved", "leaf")
    if below is not None:
        summed = summed.join(below, "id", "left").withColumns({
            "saved": F.col("saved") + F.coalesce("more", F.lit(0)), "leaf": F.col("leaf") + F.coalesce("more_leaves", F.lit(0))})
    sums = _rolled(summed, "sum(saved) AS saved_tokens, sum(leaf) AS n_leaves").select(
        _node(F.col("level"), TURNS).alias("id"), "saved_tokens", "n_leaves")
    parents = known.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (known.select("id", "parent", "conv_id", "depth", "n_convs", "n_children")
            .join(sums, "id").join(_ends(cut), "id", "left").join(parents, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), F.hex("id").alias("node")))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(turn_ids(conversations)))
