"""Exact top-k search, a block at a time.

Vectors become integers, floor(256 x). A dimension is a term, with the
smallest and the largest value that a block of documents has for it. Blocks
are ranges of documents in an order that puts like vectors together (nearest
of a few centroids, then id); a block's forward index holds its ids and its
whole matrix. For a query a block is bounded by the sum over terms of the
larger of query value times smallest and times largest block value.

First every query is scored through its two blocks of highest bound; its k-th
score so far is a threshold that the final k-th score can't fall below. Then
the blocks of each chunk of queries are taken in order of falling bound: a
block is scored for the queries whose bound for it is at or above their
current k-th score, which rises as blocks are scored, and left out for the
others. A bound equal to the threshold is kept, as ties go to smaller ids. So
the result is exact, whatever the order of documents.

Blocks and chunks of queries are packed rows of bounded size; bounds are
formed from packed rows too, a group of blocks by a chunk of queries at a
time. Centroids are fitted on at most ``SAMPLE`` vectors and affect the order
alone. Results of a task are cut to k per query before they are shuffled.

Defined cases: vectors that are null, or hold a null or a value that isn't
finite, take no part; the empty vector has score 0 with all. Vectors of
different length are compared as if the shorter went on with zeros. Null ids
take no part. Rows that repeat an id are separate candidates; a query's own
id is never its candidate, and a repeated query id is answered once, by its
first vector in order. Products beyond float64's exact range are computed in
integers of any size and clamped to 64 bits. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import partitions, written

BLOCK, QUERIES, GROUP = 256, 256, 64
CENTROIDS, SAMPLE = 32, 2048
SCALE = 256
EXACT = float(1 << 53)


def integers(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, v array<double>): whole numbers, of the rows that take part."""
    x = F.transform(column, lambda c: c.cast("double"))
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # floor() of a double is a 64-bit integer in Spark; larger values are whole already.
    whole = F.transform(x, lambda c: F.when(F.abs(c) < 2.0 ** 44, F.floor(F.when(F.abs(c) < 2.0 ** 44, c).otherwise(0.0) * SCALE).cast("double")).otherwise(c * SCALE))
    return (vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("_x"))
            .filter(F.col("vec_id").isNotNull() & F.col("_x").isNotNull())
            .select("vec_id", F.transform("_x", lambda c: c.cast("double")).alias(column))
            .filter(F.coalesce(fit, F.lit(False))).select("vec_id", whole.alias("v")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims))
    if len(column):
        sizes = np.diff(column.offsets.to_numpy())
        rows = np.repeat(np.arange(len(column)), sizes)
        cols = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[rows, cols] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def centroids(vectors: DataFrame, dims: int) -> np.ndarray:
    """A few Lloyd rounds over a bounded sample, the vectors of smallest hash."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    if not len(rows):
        return np.zeros((1, dims))
    x = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        x[i, :len(r)] = r
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    c = x[np.linspace(0, len(x) - 1, min(CENTROIDS, len(x))).astype(int)]
    for _ in range(8):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
    return c


def blocks_of(vectors: DataFrame, dims: int) -> DataFrame:
    """(block, ids, matrix, lo, hi): the forward indexes, written."""
    c = centroids(vectors, dims)

    def near(batches):
        for b in batches:
            m = _matrix(b.column(1), dims)
            norm = np.maximum(np.abs(m).max(axis=1, keepdims=True), 1e-300) if dims else 1.0
            cell = ((m / norm) @ c.T).argmax(axis=1) if len(m) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int32))], ["vec_id", "v", "cell"])

    def cut(batches):
        from pyspark import TaskContext

        part, seq, ids, rows = TaskContext.get().partitionId(), 0, [], []
        def block(ids, m):
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()),
                 pa.array([m.min(axis=0).tobytes()], pa.binary()), pa.array([m.max(axis=0).tobytes()], pa.binary())],
                ["block", "ids", "matrix", "lo", "hi"])
        left_ids, left = np.zeros(0, np.int64), np.zeros((0, dims))
        for b in batches:
            left_ids = np.concatenate([left_ids, b.column(0).to_numpy()])
            left = np.concatenate([left, _matrix(b.column(1), dims)])
            while len(left_ids) >= BLOCK:
                yield block(left_ids[:BLOCK], left[:BLOCK])
                left_ids, left, seq = left_ids[BLOCK:], left[BLOCK:], seq + 1
        if len(left_ids):
            yield block(left_ids, left)

    placed = vectors.mapInArrow(near, "vec_id long, v array<double>, cell int")
    n = partitions(vectors.sparkSession)
    return written(placed.repartitionByRange(n, "cell", "vec_id").sortWithinPartitions("cell", "vec_id").select("vec_id", "v")
                   .mapInArrow(cut, "block long, ids binary, matrix binary, lo binary, hi binary"), "topk-blocks")


def _chunks(queries: DataFrame, dims: int, many: int) -> DataFrame:
    """(chunk, ids, matrix): queries packed, a chunk by hash of the id."""
    def pack(table: pa.Table) -> pa.Table:
        t = table.sort_by([("vec_id", "ascending")]).combine_chunks()
        ids = t["vec_id"].to_numpy()
        m = _matrix(t["v"].chunk(0), dims)
        at = range(0, len(ids), QUERIES)
        base = t["chunk"][0].as_py() << 20
        return pa.table({"chunk": pa.array([base + i for i, _ in enumerate(at)], pa.int64()),
                         "ids": pa.array([ids[i:i + QUERIES].tobytes() for i in at], pa.binary()),
                         "matrix": pa.array([m[i:i + QUERIES].tobytes() for i in at], pa.binary())})
    one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    return written(one.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, many // QUERIES)))).groupBy("chunk").applyInArrow(
        pack, "chunk long, ids binary, matrix binary"), "topk-queries")


def _f64(x, dims: int) -> np.ndarray:
    return np.frombuffer(x, np.float64).reshape(-1, dims)


def _product(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """q @ d.T: float64 where it is exact, else integers of any size clamped to 64 bits."""
    if not q.size or not d.size:
        return np.zeros((len(q), len(d)), np.int64)
    if np.abs(q).max() * np.abs(d).max() * q.shape[1] < EXACT:
        return (q @ d.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in d], object).T
    return np.array([[min(max(x, -(1 << 63)), (1 << 63) - 1) for x in r] for r in big], np.int64)


def _bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least upper bounds by term, raised by the rounding that a float64 sum can lose."""
    b = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    if q.size and lo.size:
        size = np.abs(q).sum(axis=1)[:, None] * np.maximum(np.abs(hi), np.abs(lo)).max(axis=1)[None, :]
        b = b + np.where(size < EXACT, 0, size * 1e-12)
    return b


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): both inputs as ``integers`` gives them."""
    vectors = written(vectors, "topk-vectors")
    queries = written(queries, "topk-query-vectors")
    dims = max(vectors.agg(F.max(F.size("v"))).first()[0] or 0, queries.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    blocks = blocks_of(vectors, dims)
    chunks = _chunks(queries, dims, queries.count())

    bounds = blocks.select(F.floor(F.col("block") / GROUP).alias("group"), F.struct("block", "lo", "hi").alias("b")).groupBy("group").agg(
        F.collect_list("b").alias("bounds"))  # at most GROUP blocks
    bounds = written(bounds, "topk-bounds")
    return _search(blocks, bounds, chunks, dims, k)


def _cells(bounds: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every group of bounds with every chunk of queries: packed rows dealt over a fixed number of lanes."""
    lanes = partitions(bounds.sparkSession)
    left = bounds.withColumn("lane", F.pmod(F.xxhash64("group"), F.lit(lanes)).cast("int"))
    right = chunks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return left.join(right, "lane")


def _search(blocks: DataFrame, bounds: DataFrame, chunks: DataFrame, dims: int, k: int) -> DataFrame:
    def seeds(batches):
        for b in batches:
            for group in b.to_pylist():
                q = _f64(group["matrix"], dims)
                bound = _bounds(q, np.concatenate([_f64(x["lo"], dims) for x in group["bounds"]]), np.concatenate([_f64(x["hi"], dims) for x in group["bounds"]]))
                names = np.array([x["block"] for x in group["bounds"]])
                best = np.argsort(-bound, axis=1, kind="stable")[:, :2]
                rows = np.repeat(np.arange(len(q)), best.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group["chunk"]] * len(rows), pa.int64()), pa.array(rows.astype(np.int32)), pa.array(names[best.ravel()]), pa.array(bound[rows, best.ravel()])],
                    ["chunk", "row", "block", "bound"])

    first = _cells(bounds, chunks).mapInArrow(seeds, "chunk long, row int, block long, bound double")
    rank = F.row_number().over(Window.partitionBy("chunk", "row").orderBy(F.desc("bound"), "block"))
    first = first.withColumn("r", rank).filter("r <= 2").groupBy("chunk", "block").agg(
        F.max("bound").alias("bound"), F.collect_list(F.struct("row", "bound")).alias("wanted"))  # at most QUERIES rows
    found = written(_top(_scored(first, blocks, chunks, dims, k), k), "topk-seeds")
    kth = found.filter(F.col("rank") == k).select("chunk", F.struct("row", "score").alias("s")).groupBy("chunk").agg(F.collect_list("s").alias("kth"))
    told = written(chunks.join(kth, "chunk", "left"), "topk-told")

    def open_blocks(batches):
        for b in batches:
            for group in b.to_pylist():
                q = _f64(group["matrix"], dims)
                floor = np.full(len(q), -np.inf)
                for s in group["kth"] or []:
                    floor[s["row"]] = s["score"]
                bound = _bounds(q, np.concatenate([_f64(x["lo"], dims) for x in group["bounds"]]), np.concatenate([_f64(x["hi"], dims) for x in group["bounds"]]))
                for j, x in enumerate(group["bounds"]):
                    rows = np.flatnonzero(bound[:, j] >= floor)
                    if len(rows):
                        wanted = [[{"row": int(r), "bound": float(bound[r, j])} for r in rows]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([group["chunk"]], pa.int64()), pa.array([x["block"]], pa.int64()), pa.array([float(bound[rows, j].max())]),
                             pa.array(wanted, pa.list_(pa.struct([("row", pa.int32()), ("bound", pa.float64())])))],
                            ["chunk", "block", "bound", "wanted"])

    rest = _cells(bounds, told).mapInArrow(open_blocks, "chunk long, block long, bound double, wanted array<struct<row:int,bound:double>>")
    best = _top(_scored(rest, blocks, told, dims, k), k)
    return best.select(F.col("query_id"), "rank", "vec_id", "score")


def _scored(wanted: DataFrame, blocks: DataFrame, chunks: DataFrame, dims: int, k: int) -> DataFrame:
    """(chunk, row, query_id, vec_id, score): each task's k best for each query of the blocks wanted."""
    threshold = "kth" in chunks.columns
    joined = (wanted.join(blocks.select("block", F.col("ids").alias("vec_ids"), F.col("matrix").alias("vecs")), "block")
              .join(chunks.select("chunk", "ids", "matrix", (F.col("kth") if threshold else F.lit(None).cast("array<struct<row:int,score:bigint>>")).alias("kth")), "chunk"))
    ordered = joined.sortWithinPartitions("chunk", F.desc("bound"), "block")

    def run(batches):
        chunk, best, floor, ids = None, {}, None, None
        def out():
            rows = [(chunk, r, int(ids[r]), v, s) for r, top in best.items() for s, v in top]
            cols = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                              ["chunk", "row", "query_id", "vec_id", "score"])
        for b in batches:
            for i in range(b.num_rows):
                at = {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names)}
                if at["chunk"] != chunk:
                    if best:
                        yield out()
                    chunk, best = at["chunk"], {}
                    ids, q = np.frombuffer(at["ids"], np.int64), _f64(at["matrix"], dims)
                    floor = np.full(len(ids), -np.inf)
                    for s in at["kth"] or []:
                        floor[s["row"]] = s["score"]
                rows = np.array([w["row"] for w in at["wanted"] if w["bound"] >= floor[w["row"]]], np.int64)
                if not len(rows):
                    continue
                vec_ids = np.frombuffer(at["vec_ids"], np.int64)
                scores = _product(q[rows], _f64(at["vecs"], dims))
                for r, s in zip(rows, scores):
                    keep = vec_ids != ids[r]
                    keep &= s >= floor[r]
                    v, s = vec_ids[keep], s[keep]
                    if not len(v):
                        continue
                    if len(v) > k:  # all at or above the k-th score, for the ties
                        last = np.partition(s, len(s) - k)[len(s) - k]
                        v, s = v[s >= last], s[s >= last]
                    top = sorted([*best.get(r, []), *zip(s.tolist(), v.tolist())], key=lambda x: (-x[0], x[1]))[:k]
                    best[int(r)] = top
                    if len(top) == k:
                        floor[r] = max(floor[r], top[-1][0])
        if best:
            yield out()
    return ordered.mapInArrow(run, "chunk long, row int, query_id long, vec_id long, score long")


def _top(scored: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", place).filter(F.col("rank") <= k)
