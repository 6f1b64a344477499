"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the k-word grams in each window of
``LENGTH`` words, the one with the least hash. Two windows with the same
words choose the same anchor at the same place, so documents that share a
repeat of LENGTH words or more meet on a common anchor. An anchor stands for
the run of windows around it that chose it, and only runs whose anchor is
found more than once go on. There a match is extended from the anchor both
ways, window by window, as far as the windows' hashes agree with those of an
earlier place; a window that agrees covers its words, and the covered words of
overlapping windows grow together to the maximal repeats, none shorter than
LENGTH. The words of a repeat are deleted except at its first place.

Documents are dealt to chunks by id. Both joins, on anchors and on the
windows around repeated ones, are packed: a chunk sends each hash range one
block with each hash once (with the first document in the chunk that has it)
and gets a byte per hash back: whether the anchor is repeated, and whether
another chunk has an earlier place of the window. So a passage in a third of
all documents makes one entry a chunk, and no rows per word or pair are made.
Texts travel compressed.

Windows are told apart by 80 hash bits (64 and 16 of a second hash), anchors
by fewer: there a false match only takes a run along.

Defined cases: null or empty text has no words and keeps the empty text.
Rows of one id are ordered by their text; equal rows are one document, each
returned. Null ids come after all others. Extra columns are ignored. Windows
are judged on the input.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words as W
from llm.tables import partitions, written

LENGTH, GRAM = 20, 6
#: Bytes of text of a chunk, and hashes of a range, about.
CHUNK, RANGE = 3 << 20, 1 << 21
LAST = (1 << 63) - 1


def _packed_texts(docs: DataFrame, chunks: int) -> DataFrame:
    """(chunk, doc_id, z): the texts compressed."""
    def run(batches):
        for b in W.slices(batches):
            raw, off = W.text_bytes(b.column(2))
            data = raw.tobytes()
            z = [pa.compress(data[i:j], codec="zstd", asbytes=True) for i, j in zip(off[:-1], off[1:])]
            sizes = np.diff(off)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(z, pa.binary())],
                                             ["chunk", "doc_id", "size", "z"])
    rows = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "chunk long, doc_id long, size long, z binary")


class _Chunk:
    """The documents of a chunk in order, their words and their windows."""

    def __init__(self, table: pa.Table):
        rows = []
        for d, n, z in zip(table["doc_id"].to_pylist(), table["size"].to_pylist(), table["z"].to_pylist()):
            rows.append((LAST if d is None else d, pa.decompress(z, decompressed_size=n, codec="zstd", asbytes=True) if n else b"", d is None))
        rows.sort()
        self.copies: list[list] = []  # [id or None, how often]
        texts: list[bytes] = []
        ids = []
        for d, t, null in rows:
            if texts and not null and ids[-1] == d and texts[-1] == t:
                self.copies[-1][1] += 1
                continue
            self.copies.append([None if null else d, 1])
            ids.append(d)
            texts.append(t)
        self.ids, self.texts = np.array(ids, np.int64), texts
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        rows_of, starts, ends = W.word_spans(raw, off)
        hashes = W.word_hashes(raw, starts, ends)
        self.at = W.per_row(rows_of, len(texts))
        n = len(hashes) - LENGTH + 1
        if n <= 0:
            self.place = self.anchor = np.zeros(0, np.int64)
            self.window, self.tag, self.seeds = np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, np.uint64)
            return
        grams = W.grams(hashes, GRAM)
        inside = np.flatnonzero(rows_of[:n] == rows_of[LENGTH - 1:])
        wide = sliding_window_view(grams, LENGTH - GRAM + 1)
        chosen = np.concatenate([wide[i:i + 65536].argmin(axis=1) for i in range(0, n, 65536)])
        #: Of each window: its first word, its document, its hash, the anchor's index among ``seeds``.
        self.place = inside
        self.seeds, self.anchor = np.unique(grams[inside + chosen[inside]], return_inverse=True)
        whole = W.grams(hashes, LENGTH)[inside]
        self.window = whole
        self.tag = (W.mix(whole + hashes[inside] * np.uint64(3) + hashes[inside + LENGTH - 1]) >> np.uint64(48)).astype(np.uint16)
        self.doc = rows_of[inside]
        runs = np.ones(len(inside), bool)
        spot = inside + chosen[inside]
        runs[1:] = spot[1:] != spot[:-1]
        self.occurrences = np.bincount(self.anchor[runs], minlength=len(self.seeds))

    def chosen_windows(self, repeated: np.ndarray):
        """Windows under repeated anchors, each hash once: (hash, tag, first document, inverse, indices)."""
        at = np.flatnonzero(repeated[self.anchor]) if len(self.place) else np.zeros(0, np.int64)
        both = np.empty(len(at), [("h", np.uint64), ("t", np.uint16)])
        both["h"], both["t"] = self.window[at], self.tag[at]
        order = np.lexsort((np.arange(len(at)), both["t"], both["h"]))
        s = both[order]
        new = np.ones(len(at), bool)
        new[1:] = s[1:] != s[:-1]
        group = np.cumsum(new) - 1
        inverse = np.empty(len(at), np.int64)
        inverse[order] = group
        first = order[new]  # windows go up by document and place
        return both["h"][first], both["t"][first], first, inverse, at


def _by_range(h: np.ndarray, ranges: int):
    r = ((h >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(r, kind="stable")
    found, start = np.unique(r[order], return_index=True)
    return order, found, np.append(start, len(r))


def _told(answers: pa.Table, step: int, h: np.ndarray, ranges: int) -> np.ndarray:
    """The byte that came back for each hash."""
    mine = answers.filter(pa.compute.equal(answers["step"], step))
    blocks = sorted(zip(mine["range"].to_pylist(), mine["codes"].to_pylist()))
    out = np.zeros(len(h), np.uint8)
    if blocks:
        out[_by_range(h, ranges)[0]] = np.concatenate([np.frombuffer(c, np.uint8) for _, c in blocks])
    return out


def _ask_anchors(ranges: int):
    def run(texts: pa.Table) -> pa.Table:
        c = _Chunk(texts)
        many = np.minimum(c.occurrences, 2).astype(np.uint8) if len(c.seeds) else np.zeros(0, np.uint8)
        order, found, cut = _by_range(c.seeds, ranges)
        low = (c.seeds[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        many = many[order]
        return pa.table({"chunk": pa.array([texts["chunk"][0].as_py()] * len(found), pa.int64()), "range": pa.array(found, pa.int64()),
                         "keys": pa.array([low[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()),
                         "counts": pa.array([many[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())})
    return run


def _tell_anchors(asked: pa.Table) -> pa.Table:
    keys = [np.frombuffer(x, np.uint32) for x in asked["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in asked["counts"].to_pylist()])
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    repeated = (np.bincount(inverse, weights=counts)[inverse] >= 2).astype(np.uint8)
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"chunk": asked["chunk"], "range": asked["range"], "step": pa.array([1] * len(keys), pa.int32()),
                     "codes": pa.array([repeated[e - len(k):e].tobytes() for k, e in zip(keys, ends)], pa.binary())})


def _ask_windows(anchor_ranges: int, ranges: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        c = _Chunk(texts)
        h, t, first, _, at = c.chosen_windows(_told(answers, 1, c.seeds, anchor_ranges) > 0)
        order, found, cut = _by_range(h, ranges)
        doc = c.doc[at[first]][order] if len(h) else np.zeros(0, np.int64)
        h, t = h[order], t[order]
        ids, index = np.unique(c.ids[doc], return_inverse=True)
        index = index.astype(np.uint16 if len(ids) <= 65536 else np.uint32)
        blocks = [(h[i:j].tobytes(), t[i:j].tobytes(), index[i:j].tobytes()) for i, j in zip(cut, cut[1:])] if len(found) else []
        return pa.table({"chunk": pa.array([texts["chunk"][0].as_py()] * len(found), pa.int64()), "range": pa.array(found, pa.int64()),
                         "keys": pa.array([b[0] for b in blocks], pa.binary()), "tags": pa.array([b[1] for b in blocks], pa.binary()),
                         "docs": pa.array([b[2] for b in blocks], pa.binary()), "ids": pa.array([ids.tobytes()] * len(found), pa.binary())})
    return run


def _tell_windows(asked: pa.Table) -> pa.Table:
    keys = [np.frombuffer(x, np.uint64) for x in asked["keys"].to_pylist()]
    h = np.concatenate(keys)
    t = np.concatenate([np.frombuffer(x, np.uint16) for x in asked["tags"].to_pylist()])
    docs = []
    for k, x, i in zip(keys, asked["docs"].to_pylist(), asked["ids"].to_pylist()):
        docs.append(np.frombuffer(i, np.int64)[np.frombuffer(x, np.uint16 if len(x) == 2 * len(k) else np.uint32)])
    d = np.concatenate(docs)
    order = np.lexsort((d, t, h))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (t[order][1:] != t[order][:-1])
    least = d[order][new][np.cumsum(new) - 1]
    later = np.empty(len(h), np.uint8)
    later[order] = least < d[order]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"chunk": asked["chunk"], "range": asked["range"], "step": pa.array([2] * len(keys), pa.int32()),
                     "codes": pa.array([later[e - len(k):e].tobytes() for k, e in zip(keys, ends)], pa.binary())})


def _delete(anchor_ranges: int, ranges: int, with_text: bool):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        c = _Chunk(texts)
        h, _, first, inverse, at = c.chosen_windows(_told(answers, 1, c.seeds, anchor_ranges) > 0)
        later = _told(answers, 2, h, ranges) > 0
        again = later[inverse]
        own = np.ones(len(at), bool)
        own[first] = False
        again |= own  # only a hash's first window in the chunk can be its first place
        edge = np.zeros(int(c.at[-1]) + 1, np.int32)
        covered_from = c.place[at[again]] if len(at) else np.zeros(0, np.int64)
        np.add.at(edge, covered_from, 1)
        np.add.at(edge, covered_from + LENGTH, -1)
        gone = np.cumsum(edge[:-1]) > 0
        out: list[tuple] = []
        for (doc, times), text, i, j in zip(c.copies, c.texts, c.at[:-1], c.at[1:]):
            words, cut = text.split(), gone[i:j]
            n_gone = int(cut.sum())
            kept = b" ".join(compress(words, (~cut).tolist()) if n_gone else words)
            out += [(doc, int(j - i), n_gone, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None)] * times
        cols = list(zip(*out)) or [()] * 5
        made = {"doc_id": pa.array(cols[0], pa.int64()), "n_words": pa.array(cols[1], pa.int64()),
                "n_removed": pa.array(cols[2], pa.int64()), "kept_sha256": pa.array(cols[3], pa.string())}
        return pa.table(made | ({"kept": pa.array(cols[4], pa.string())} if with_text else {}))
    return run


def dedup_substrings(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of ``docs``; ``with_text``: the kept words too."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(partitions(spark), size // CHUNK + 1)
    anchor_ranges, ranges = size // 48 // RANGE + 1, size // 12 // RANGE + 1
    texts = _packed_texts(docs, chunks)
    asked = texts.groupBy("chunk").applyInArrow(_ask_anchors(anchor_ranges), "chunk long, range long, keys binary, counts binary")
    told = "chunk long, range long, step int, codes binary"
    anchors = asked.groupBy("range").applyInArrow(_tell_anchors, told)
    anchors = written(anchors, "anchor-answers")
    windows = (texts.groupBy("chunk").cogroup(anchors.groupBy("chunk"))
               .applyInArrow(_ask_windows(anchor_ranges, ranges), "chunk long, range long, keys binary, tags binary, docs binary, ids binary")
               .groupBy("range").applyInArrow(_tell_windows, told))
    answers = anchors.unionByName(written(windows, "window-answers"))
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _delete(anchor_ranges, ranges, with_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))
