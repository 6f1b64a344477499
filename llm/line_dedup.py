"""Line dedup by pairwise alignment.

Documents overlap when they share a run of consecutive lines of
``MIN_CHARS`` characters or more (blanks around lines not counted); single
lines that long are such runs. Of every document the shortest runs that begin
or end at each line are its keys, so every line of a common run that long
lies in a common key. A key joins every document that holds it with the
earliest one that does, so a line that thousands of documents share costs one
pair per document. Where a line of a key outlives that, its document is
joined with the next earlier holders of the key, in rounds of twice as many
each (``deletions``), until no line that is left has an earlier holder that
it was not aligned with: the same lines go as if every pair of documents had
been aligned.

Each pair is aligned by patience diff over the line hashes of both
documents: lines that are unique in both are matched along a longest
increasing run, matches grow over equal neighbours, and the gaps are aligned
the same way; a gap without such lines by a longest common subsequence. A
common block of ``MIN_CHARS`` characters or more is deleted from the later
document.

All pairs are judged on the input. The earliest document with a line never
loses it for that line's sake, so one copy stays.

Defined cases: order is by ``doc_id``; rows with the same id are not aligned
with each other; null ids and null or empty texts come back unchanged. A
document that loses every line is dropped by ``clean_documents`` and has an
empty text in ``dedup_lines``. ``n_chars``, where there is such a column,
follows the text. Extra columns are kept, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import releasing, set_aside, written

MIN_CHARS = 24
#: Parts, by ranges of the id, in which the holders of one key are numbered.
PARTS = 64
#: Bits of one table of the longest common subsequence; larger gaps are halved first.
TABLE_BITS = 1 << 28


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by their first) that rises in both places."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back.append(at[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _lcs_rows(a: list, b: list) -> list[int]:
    """After each line of a, a number whose bit j is 0 where b[:j + 1] has one more common line than b[:j]."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, v = [], full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _lcs_lengths(a: list, b: list) -> list[int]:
    """Length of the longest common subsequence of a with b[:j], for every j from 0."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out = [0]
    for bit in reversed(f"{v:0{len(b)}b}" if b else ""):
        out.append(out[-1] + (bit == "0"))
    return out


def _lcs(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of a longest common subsequence, rising."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if i0 >= i1 or j0 >= j1:
            continue
        if i1 - i0 > 1 and (i1 - i0) * (j1 - j0) > TABLE_BITS:
            mid, part = (i0 + i1) // 2, b[j0:j1]
            left, right = _lcs_lengths(a[i0:mid], part), _lcs_lengths(a[mid:i1][::-1], part[::-1])
            cut = j0 + max(range(len(part) + 1), key=lambda j: left[j] + right[len(part) - j])
            todo += [(i0, mid, j0, cut), (mid, i1, cut, j1)]
            continue
        rows = _lcs_rows(a[i0:i1], b[j0:j1])
        i, j = i1 - i0 - 1, j1 - j0 - 1
        while i >= 0 and j >= 0:
            if rows[i] >> j & 1:  # b[j] adds nothing
                j -= 1
            elif i and not rows[i - 1] >> j & 1:  # nor does a[i]
                i -= 1
            else:
                out.append((i0 + i, j0 + j))
                i, j = i - 1, j - 1
    return sorted(out)


def patience(a: list, b: list) -> list[tuple[int, int, int]]:
    """Common blocks (start in a, start in b, length) of a patience alignment; gaps without unique lines by LCS."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            matched.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            matched.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        once_a: dict = {}
        for i in range(i0, i1):
            once_a[a[i]] = -1 if a[i] in once_a else i
        once_b: dict = {}
        for j in range(j0, j1):
            once_b[b[j]] = -1 if b[j] in once_b else j
        run = _increasing(sorted((i, once_b[x]) for x, i in once_a.items() if i >= 0 and once_b.get(x, -1) >= 0))
        if not run:
            common = once_a.keys() & once_b.keys()
            if common:
                at_a, at_b = ([k for k in range(k0, k1) if x[k] in common] for x, k0, k1 in ((a, i0, i1), (b, j0, j1)))
                matched += [(at_a[i], at_b[j]) for i, j in _lcs([a[k] for k in at_a], [b[k] for k in at_b])]
            continue
        for (i, j), (i2, j2) in zip([(i0 - 1, j0 - 1), *run], [*run, (i1, j1)]):
            todo.append((i + 1, i2, j + 1, j2))
        matched += run
    blocks: list[tuple[int, int, int]] = []
    for i, j in sorted(matched):
        if blocks and (i, j) == (blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]):
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def _sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, version, lines): hashes of the lines in order, and their lengths as far as MIN_CHARS."""
    lines = F.split("text", "\n")
    return (docs.filter("doc_id is not null and length(text) > 0")
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
                    F.transform(lines, lambda x: F.struct(
                        F.xxhash64(x).alias("h"), F.least(F.length(F.btrim(x, F.lit(" \t\r"))), F.lit(MIN_CHARS)).alias("n"))).alias("lines")))


#: An odd factor of the hash of a run, and its inverse by 2^64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def keys_of(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, end): the shortest runs of MIN_CHARS or more that begin or end at each line, each once."""
    sums = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    at = np.arange(len(n))
    end = np.searchsorted(sums, sums[:-1] + MIN_CHARS)
    start = np.searchsorted(sums, sums[1:] - MIN_CHARS, "right") - 1
    ahead, behind = end <= len(n), start >= 0
    both = np.unique(np.concatenate([np.stack([at[ahead], end[ahead]], 1), np.stack([start[behind], at[behind] + 1], 1)]), axis=0)
    power, back = (np.cumprod(np.array([1] + [x] * len(n), np.uint64), dtype=np.uint64) for x in (_BASE, _BACK))
    heads = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h.astype(np.int64).view(np.uint64) * power[:-1], dtype=np.uint64)])
    s, e = both[:, 0], both[:, 1]
    return ((heads[e] - heads[s]) * back[s]).view(np.int64), s, e


def _held(sequences: DataFrame) -> DataFrame:
    """(doc_id, version, h, start, stop): every key of every document."""
    def run(batches):
        for batch in batches:
            lines = batch.column(2)
            got = [keys_of(*(x.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))) for x in (y.values for y in lines)]
            many = [len(g[0]) for g in got]
            cols = [np.concatenate(c) if got else np.zeros(0, np.int64) for c in zip(*got)] or [np.zeros(0, np.int64)] * 3
            ids, versions = (np.repeat(batch.column(k).to_numpy(zero_copy_only=False), many) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(versions, pa.int64()), pa.array(cols[0], pa.int64()),
                                              pa.array(cols[1].astype(np.int32)), pa.array(cols[2].astype(np.int32))],
                                             ["doc_id", "version", "h", "start", "stop"])
    return sequences.mapInArrow(releasing(run), "doc_id long, version long, h long, start int, stop int")


def _aligned(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """(doc_id, version, at): the lines that the alignments of ``pairs`` (doc_id, version, earlier) delete, each once."""
    earlier = sequences.select(F.col("doc_id").alias("earlier"), F.col("lines.h").alias("theirs"))
    both = (pairs.join(earlier, "earlier").join(sequences, ["doc_id", "version"])
            .select("doc_id", "version", F.col("lines.h").alias("ours"), F.col("lines.n").alias("n"), "theirs"))

    def run(batches):
        for batch in batches:
            ids, versions, at = [], [], []
            ours, chars, theirs = (batch.column(k) for k in (2, 3, 4))
            for d, v, a, size, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ours, chars, theirs):
                a, size = a.values.to_pylist(), size.values.to_pylist()
                for i, _, n in patience(a, b.values.to_pylist()):
                    if sum(size[i:i + n]) >= MIN_CHARS:
                        ids += [d] * n
                        versions += [v] * n
                        at += range(i, i + n)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(versions, pa.int64()), pa.array(at, pa.int32())],
                                             ["doc_id", "version", "at"])
    return both.mapInArrow(releasing(run), "doc_id long, version long, at int").distinct()


def _ranked(holders: DataFrame) -> DataFrame:
    """``holders`` (h, doc_id), with ``rank``: the place of the id among the holders of h, from 0."""
    cuts = sorted(set(holders.approxQuantile("doc_id", [k / PARTS for k in range(1, PARTS)], 1 / (4 * PARTS))))
    part = sum(((F.col("doc_id") > F.lit(int(c))).cast("int") for c in cuts), F.lit(0))
    placed = holders.withColumn("part", part)
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most PARTS rows a key.
    offsets = (placed.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    local = F.row_number().over(Window.partitionBy("h", "part").orderBy("doc_id"))
    return placed.withColumn("local", local).join(offsets, ["h", "part"]).select("h", "doc_id", (F.col("before") + F.col("local") - 1).alias("rank"))


def _left(held: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``held`` of whose lines some are not in ``gone``."""
    by_doc = gone.groupBy("doc_id", "version").agg(F.collect_set("at").alias("_at"))  # at most the lines of a text
    lost = F.size(F.filter("_at", lambda x: (x >= F.col("start")) & (x < F.col("stop"))))
    return held.join(by_doc, ["doc_id", "version"], "left").filter(F.coalesce(lost, F.lit(0)) < F.col("stop") - F.col("start")).drop("_at")


def deletions(sequences: DataFrame) -> DataFrame:
    """(doc_id, version, at): the lines to delete, each once."""
    held = written(_held(sequences), "line-keys")
    first = held.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("h", "first")
    shared = written(held.join(first, "h"), "line-shared-keys")
    done = written(shared.filter("first < doc_id").select("doc_id", "version", F.col("first").alias("earlier")).distinct(), "line-pairs")
    gone = written(_aligned(done, sequences), "line-gone")
    left = written(_left(shared.filter("first < doc_id"), gone), "line-left")
    if left.isEmpty():
        return gone
    ranks = written(_ranked(shared.join(left.select("h").distinct(), "h", "left_semi").select("h", "doc_id").distinct()), "line-ranks")
    left = written(left.join(ranks.withColumnRenamed("rank", "mine"), ["h", "doc_id"]).filter("mine > 1"), "line-left")
    lo = 1
    while not left.isEmpty():
        # Of each key that is left the next holders, as many as were tried before.
        some = ranks.filter((F.col("rank") >= lo) & (F.col("rank") < 2 * lo)).withColumnRenamed("doc_id", "earlier")
        pairs = (left.select("h", "doc_id", "version", "mine").distinct().join(some, "h").filter("rank < mine")
                 .select("doc_id", "version", "earlier").distinct())
        pairs = written(pairs.join(done, ["doc_id", "version", "earlier"], "left_anti"), "line-pairs")
        new = written(_aligned(pairs, sequences), "line-gone")
        done, gone = done.unionByName(pairs), gone.unionByName(new)
        lo *= 2
        left = written(_left(left.filter(F.col("mine") > lo), gone), "line-left")
    return gone.distinct()


def _with_deletions(docs: DataFrame) -> DataFrame:
    """``docs``, with ``_n_lines``, ``_n_deleted`` and the text without the deleted lines as ``_clean``."""
    sequences = written(_sequences(docs), "line-sequences")
    gone = written(deletions(sequences).groupBy("doc_id", "version").agg(F.sort_array(F.collect_list("at")).alias("_at"))
                   .withColumnRenamed("doc_id", "_doc").withColumnRenamed("version", "_version"), "line-deletions")
    kept = docs.join(gone, (F.col("doc_id").cast("long") == F.col("_doc")) & (F.xxhash64("text") == F.col("_version")), "left")
    schema = kept.drop("_doc", "_version", "_at").schema.add("_n_lines", "long").add("_n_deleted", "long").add("_clean", "string")

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text")).to_pylist()
            at = batch.column(batch.schema.get_field_index("_at"))
            n_lines, n_deleted, clean = [], [], []
            for t, gone_at in zip(text, at):
                lines = t.split("\n") if t else []
                n_lines.append(len(lines))
                if not gone_at.is_valid:
                    n_deleted.append(0)
                    clean.append(t)
                    continue
                stay = np.ones(len(lines), bool)
                stay[gone_at.values.to_numpy()] = False
                n_deleted.append(int(len(lines) - stay.sum()))
                clean.append("\n".join(x for x, s in zip(lines, stay) if s))
            rest = [c for c in batch.schema.names if c not in ("_doc", "_version", "_at")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in rest), pa.array(n_lines, pa.int64()),
                 pa.array(n_deleted, pa.int64()), pa.array(clean, pa.string())], [*rest, "_n_lines", "_n_deleted", "_clean"])
    return kept.mapInArrow(releasing(run), schema)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: (doc_id, n_lines, n_deleted, clean_sha256, text)."""
    return _with_deletions(docs.select("doc_id", "text")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"),
        F.sha2(F.coalesce("_clean", F.lit("")), 256).alias("clean_sha256"))


def clean_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the deleted lines; documents that had words and lost them all go."""
    rows = set_aside(docs, ("doc_id", "text", "n_chars"))
    done = _with_deletions(rows).filter((F.col("_n_deleted") == 0) | (F.length(F.btrim("_clean", F.lit(" \t\n\x0b\x0c\r"))) > 0))
    new = {"text": F.col("_clean")}
    if "n_chars" in rows.columns:
        new["n_chars"] = F.when(F.col("_n_deleted") > 0, F.length("_clean").cast(rows.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns]).toDF(*docs.columns)
