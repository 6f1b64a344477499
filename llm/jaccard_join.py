"""Size-aware heavy-light Jaccard join over word shingles.

Sets: the distinct 5-word shingles of a document's words (A-Z lower-cased).
Sets that are equal are one vertex, so exact copies never meet as pairs.

Two sets with Jaccard similarity >= t overlap in at least ceil(t n) members
of a set of n, so under any fixed order of all shingles they share at least k
members among their first n - ceil(t n) + k ones. The order is by document
frequency (rarest first), so that members found in one set only, which can
link nothing, fill those prefixes first. Small sets are put under a key for
each subset of k = 2 members of their prefix; large sets are scanned through
the inverted lists of the single members of theirs (k = 1). Sets just below
the boundary stand in both indexes, so no pair of sizes is missed. The
boundary is the one of least estimated cost: a row for each subset that a
size would make, against a row and a quarter of the logarithm of its list's
length for each member that it would scan (lists are not scanned pair by
pair, see below, so their length counts for little).

A key's place in a set's order bounds what the two sets can share if the key
is the first one in common, and pairs for which that is too little are not
compared (a pair that links has such a first key, so none is lost).

Below a key, sets are not paired with each other. First every set is compared
with one other, the first document among the heads of its keys, and the
components of the links so found are built. In a few more turns every set
outside the largest component of a key is compared with one inside. Only keys
that then still hold more than one component are taken whole, and there sets
outside the key's largest component are paired with the sets of other
components, under the first key that the two share (sets with a prefix over
``CARRIED`` members: under each), and only if bitmaps of their members (a bit
set in one alone is a member that the other lacks) leave room for the bound.
Every pair that shares a key is therefore compared, ruled out by an exact
bound or already connected: no link that changes a component is lost, and
a group of many near copies costs a few comparisons a set, not one per pair.

Document frequencies cover every set. They are counted by packed requests: a
chunk of documents sends each range of shingles as one block of 32-bit keys
and gets back one byte a key (the logarithm of the frequency), so no row is
made per word. Keys that collide share a frequency, which affects the order
alone, and that the same way in every set.

Defined cases: null or empty text, or text without words: an empty set, its
own component, no link. Null ``doc_id``: the row is returned with a null
component and links nothing. Repeated ``doc_id``: the rows are one vertex.
Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words as W
from llm.components import components
from llm.tables import partitions, releasing, releasing_group, releasing_pair, set_aside, written

SHINGLE = 5
#: Similarity bound as a fraction of whole numbers: 80 / 100.
NUM, DEN = 80, 100
#: Texts go to chunks of about this many shingles, requests to ranges of about that many.
CHUNK, RANGE = 1 << 19, 1 << 21
#: Sizes up to which a boundary between small and large sets is considered.
MOST_SMALL = 256
#: Turns (1 or more) in which every set outside its keys' main components is compared with one set inside.
TURNS = 1
#: Members of a prefix up to which it goes along with a set's last pairs, and bits of the bitmap of a set's members.
CARRIED, BITS = 256, 1024


def shingle_sets(texts, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    raw, off = W.text_bytes(texts)
    rows, starts, ends = W.word_spans(raw, off)
    hashes = W.word_hashes(raw, starts, ends, lower=True)
    at = W.per_row(rows, len(off) - 1)
    grams = W.grams(hashes, k)
    out = []
    for i, j in zip(at[:-1], at[1:]):
        if j - i >= k:
            out.append(np.unique(grams[i:j - k + 1]))
        elif j > i:
            out.append(W.grams(hashes[i:j], int(j - i)))  # the whole sequence as one
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _least_overlap(n):
    """Smallest overlap of a set of n with any set that it can link with."""
    return -(-NUM * n // DEN)


def sets_of(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key) of every row; the key is null for an empty set."""
    def run(batches):
        for b in W.slices(batches):
            sets = shingle_sets(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "set_key"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        releasing(run), "doc_id long, n_shingles long, set_key binary")


def _chunked(docs: DataFrame, chunks: int) -> DataFrame:
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))


def _actors(texts: pa.Table, allowed: pa.Table):
    """(doc_id, set) once for every vertex of the chunk, by doc_id."""
    want = set(zip(allowed["doc_id"].to_pylist(), allowed["set_key"].to_pylist()))
    out = []
    for b in W.slices(iter(texts.combine_chunks().to_batches())):
        ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
        for d, s in zip(ids, shingle_sets(b.column(b.schema.get_field_index("text")))):
            if len(s) and (d, key := _set_key(s)) in want:
                want.discard((d, key))
                out.append((d, key, s))
    out.sort(key=lambda x: x[:2])
    return out


def _ranged(sets: list[np.ndarray], ranges: int):
    """Distinct shingles of a chunk in order of their range: hashes, range of each, sets that hold each."""
    if not sets:
        z = np.zeros(0, np.uint64)
        return z, z.astype(np.int64), z.astype(np.int64)
    h, n = np.unique(np.concatenate(sets), return_counts=True)
    r = ((h >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(r, kind="stable")
    return h[order], r[order], n[order]


def _bitmap(s: np.ndarray) -> np.ndarray:
    """``BITS`` bits as 64-bit integers; each member sets one."""
    bits = np.zeros(BITS, np.uint8)
    bits[(s % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _requests(ranges: int):
    def run(texts: pa.Table, allowed: pa.Table) -> pa.Table:
        chunk = (texts if texts.num_rows else allowed)["chunk"][0].as_py()
        h, r, n = _ranged([s for _, _, s in _actors(texts, allowed)], ranges)
        found, first = np.unique(r, return_index=True)
        last = np.append(first[1:], len(r))
        low, many = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.minimum(n, 65535).astype(np.uint16)
        return pa.table({
            "chunk": pa.array([chunk] * len(found), pa.int64()), "range": pa.array(found, pa.int64()),
            "keys": pa.array([low[i:j].tobytes() for i, j in zip(first, last)], pa.binary()),
            "counts": pa.array([many[i:j].tobytes() for i, j in zip(first, last)], pa.binary())})
    return run


def _answers(table: pa.Table) -> pa.Table:
    """For each block of keys, a byte a key: 0 if one set has it, else 8 log2 of the sets that do."""
    keys = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint16) for x in table["counts"].to_pylist()]).astype(np.float64)
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=counts)[inverse]
    codes = np.where(total < 2, 0, np.minimum(255, np.rint(8 * np.log2(np.maximum(total, 1))))).astype(np.uint8)
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"chunk": table["chunk"], "range": table["range"],
                     "codes": pa.array([codes[e - len(k):e].tobytes() for k, e in zip(keys, ends)], pa.binary())})


def _prefixes(ranges: int):
    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        is_set = told["codes"].is_null()
        allowed, codes = told.filter(is_set), told.filter(pa.compute.invert(is_set))
        actors = _actors(texts, allowed)
        h, r, _ = _ranged([s for _, _, s in actors], ranges)
        blocks = sorted(zip(codes["range"].to_pylist(), codes["codes"].to_pylist()))
        code = np.concatenate([np.frombuffer(c, np.uint8) for _, c in blocks]) if blocks else np.zeros(0, np.uint8)
        order = np.argsort(h)
        h, code = h[order], code[order]
        cols: dict[str, list] = {k: [] for k in ("doc_id", "n", "members", "bits", "prefix", "room", "n_single", "scan")}
        for d, _, s in actors:
            n = len(s)
            c = code[np.searchsorted(h, s)]
            single = n - _least_overlap(n) + 1
            if n < 4 or np.count_nonzero(c == 0) >= single:
                continue  # equal sets only, or too few members that any other set has
            rank = np.lexsort((s, c))[:single + 1]
            c, p = c[rank], s[rank]
            shared = c > 0
            cols["doc_id"].append(d)
            cols["n"].append(n)
            cols["members"].append(s.tobytes())
            cols["bits"].append(_bitmap(s))
            cols["prefix"].append(W.signed(p[shared]))
            cols["room"].append((n - np.flatnonzero(shared)).astype(np.int64))
            cols["n_single"].append(int(np.count_nonzero(shared[:single])))
            cols["scan"].append(float((1 + c[:single][shared[:single]] / 32.0).sum()))
        return pa.table({"doc_id": pa.array(cols["doc_id"], pa.int64()), "n": pa.array(cols["n"], pa.int64()),
                         "members": pa.array(cols["members"], pa.binary()), "bits": pa.array(cols["bits"], pa.list_(pa.int64())), "prefix": pa.array(cols["prefix"], pa.list_(pa.int64())),
                         "room": pa.array(cols["room"], pa.list_(pa.int64())),
                         "n_single": pa.array(cols["n_single"], pa.int32()), "scan": pa.array(cols["scan"], pa.float64())})
    return run


def prefixes(docs: DataFrame, vertices: DataFrame) -> DataFrame:
    """Vertices that may link: members, their shared prefix members in order, and the cost of scanning their lists."""
    total = vertices.agg(F.sum("n_shingles")).first()[0] or 0
    chunks, ranges = max(partitions(docs.sparkSession), total // CHUNK + 1), total // RANGE + 1
    texts = _chunked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null"), chunks)
    allowed = _chunked(vertices.select("doc_id", "set_key"), chunks)
    asked = texts.groupBy("chunk").cogroup(allowed.groupBy("chunk")).applyInArrow(
        releasing_pair(_requests(ranges)), "chunk long, range long, keys binary, counts binary")
    answers = asked.groupBy("range").applyInArrow(releasing_group(_answers), "chunk long, range long, codes binary")
    told = allowed.select("chunk", "doc_id", "set_key", F.lit(None).cast("long").alias("range"), F.lit(None).cast("binary").alias("codes")).unionByName(
        answers.select("chunk", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("set_key"), "range", "codes"))
    return texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        releasing_pair(_prefixes(ranges)), "doc_id long, n long, members binary, bits array<bigint>, prefix array<bigint>, room array<bigint>, n_single int, scan double")


def boundary(found: DataFrame) -> int:
    """Largest size of a small set: the one of least estimated cost."""
    pairs = F.size("prefix") * (F.size("prefix") - 1) / 2
    sizes = (found.groupBy(F.least("n", F.lit(MOST_SMALL + 1)).alias("n"))
             .agg(F.sum(pairs).alias("subsets"), F.sum("scan").alias("scan")).collect())
    def cost(x: int) -> float:
        return sum((r["subsets"] if r["n"] <= x else 0) + (r["scan"] if DEN * r["n"] >= NUM * x else 0) for r in sizes)
    return min(range(MOST_SMALL + 1), key=lambda x: (cost(x), x))


def postings(found: DataFrame, x: int) -> DataFrame:
    """(kind, key, doc_id, n, room): subsets of two for sets up to x, single members for sets from t x on.

    ``room``: the most members that a set can share with another if this key
    is the first that they share; with a key of two members, the first counts
    on top of those from the second on.
    """
    spot = F.transform("prefix", lambda k, i: F.struct(k.alias("k"), F.get("room", i).alias("r")))
    two = F.flatten(F.transform("_spots", lambda a, i: F.transform(
        F.slice("_spots", i + 2, F.size("_spots")), lambda b: F.struct(F.xxhash64(a["k"], b["k"]).alias("k"), (b["r"] + 1).alias("r")))))
    spots = found.withColumn("_spots", spot)
    small = spots.filter(F.col("n") <= x).select(F.lit(2).alias("kind"), F.explode(two).alias("s"), "doc_id", "n")
    large = spots.filter(DEN * F.col("n") >= NUM * x).select(
        F.lit(1).alias("kind"), F.explode(F.slice("_spots", F.lit(1), F.col("n_single"))).alias("s"), "doc_id", "n")
    return small.unionByName(large).select("kind", F.col("s.k").alias("key"), "doc_id", "n", F.col("s.r").alias("room"))


def _may_link(a: str, b: str, room_a: str, room_b: str):
    """Whether the overlap that the key leaves room for can reach the bound."""
    return (DEN + NUM) * F.least(room_a, room_b) >= NUM * (F.col(a) + F.col(b))


def verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the bound, by their whole sets."""
    side = found.select("doc_id", "members")
    both = (pairs.join(side.select(F.col("doc_id").alias("a"), F.col("members").alias("ma")), "a")
            .join(side.select(F.col("doc_id").alias("b"), F.col("members").alias("mb")), "b").select("a", "b", "ma", "mb"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                shared = int(np.count_nonzero(q[at] == p))
                keep.append(DEN * shared >= NUM * (len(p) + len(q) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return both.mapInArrow(releasing(run), "a long, b long").distinct()


def _marked(lists: DataFrame, links_so_far: DataFrame) -> DataFrame:
    """The postings of keys that hold more than one component, with the components and the key's largest one."""
    named = components(links_so_far).withColumnRenamed("node", "doc_id")
    marked = lists.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    per = marked.groupBy("kind", "key", "component").agg(F.count(F.lit(1)).alias("m"))
    open_keys = (per.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("m", "component")).alias("main"))
                 .filter("parts > 1").select("kind", "key", "main"))
    return written(marked.join(open_keys, ["kind", "key"]), "jaccard-open")


def _one_each(lists: DataFrame, turn: int) -> DataFrame:
    """A pair (a, b) for each set at most: with the first, in this turn's order, of the heads of its keys.

    A key's head is its first set in the turn's order; from the second turn on
    only keys of several components count, and heads of the key's main one.
    """
    order = F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", F.lit(turn))
    pool = lists if turn == 0 else lists.filter("component = main")
    heads = pool.groupBy("kind", "key").agg(F.min(F.struct(order.alias("o"), F.col("doc_id").alias("head"), F.col("n").alias("hn"), F.col("room").alias("hr"))).alias("h")).select("kind", "key", "h.*")
    seekers = lists if turn == 0 else lists.filter("component <> main")
    met = seekers.join(heads, ["kind", "key"]).filter((F.col("doc_id") != F.col("head")) & _may_link("n", "hn", "room", "hr"))
    return (met.groupBy("doc_id").agg(F.min_by("head", "o").alias("head"))
            .select(F.least("doc_id", "head").alias("a"), F.greatest("doc_id", "head").alias("b")).distinct())


def _last_pairs(rest: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) under keys of several components: their sets outside the largest one against those of other components.

    A pair comes once, under the first key that both sets have, if both
    prefixes are carried; the orders of the two agree, so that key is known.
    """
    rest = rest.join(found.select("doc_id", "n", "bits", F.when(F.size("prefix") <= CARRIED, F.col("prefix")).alias("prefix")), ["doc_id", "n"])
    others = rest.filter("component <> main").select(
        "kind", "key", F.col("doc_id").alias("o"), F.col("n").alias("on"), F.col("room").alias("oroom"), F.col("component").alias("oc"),
        F.col("bits").alias("obits"), F.col("prefix").alias("oprefix"))
    apart = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("obits")[i])) for i in range(BITS // 64)), F.lit(0))
    both = F.array_intersect("prefix", "oprefix")
    first = F.when(F.col("kind") == 1, F.get(both, F.lit(0))).otherwise(F.xxhash64(F.get(both, F.lit(0)), F.get(both, F.lit(1))))
    once = F.col("prefix").isNull() | F.col("oprefix").isNull() | (first == F.col("key"))
    return (rest.join(others, ["kind", "key"])
            .filter((F.col("component") != F.col("oc")) & ((F.col("component") == F.col("main")) | (F.col("doc_id") < F.col("o")))
                    & _may_link("n", "on", "room", "oroom")
                    & ((DEN + NUM) * (F.col("n") + F.col("on") - apart) >= 2 * NUM * (F.col("n") + F.col("on"))) & once)
            .select(F.least("doc_id", "o").alias("a"), F.greatest("doc_id", "o").alias("b")).distinct())


def links(found: DataFrame) -> DataFrame:
    """Enough links (a, b) between vertices to connect all that are connected."""
    found = written(found, "jaccard-sets")
    lists = postings(found, boundary(found))
    lists = written(lists.join(lists.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("kind", "key"), ["kind", "key"]), "jaccard-lists")
    sure = written(verified(_one_each(lists, 0), found), "jaccard-links")
    rest = _marked(lists, sure)
    for turn in range(1, TURNS + 1):
        sure = written(sure.unionByName(verified(_one_each(rest, turn), found)), "jaccard-links")
        rest = _marked(rest.select(*lists.columns), sure)
    return sure.unionByName(verified(_last_pairs(rest, found), found))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of ``docs``."""
    sets = written(sets_of(docs), "shingle-sets")
    known = sets.filter("doc_id is not null and set_key is not null")
    first = known.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n_shingles"))
    vertices = first.select(F.col("first").alias("doc_id"), "set_key", "n_shingles")
    joined = links(prefixes(docs, vertices))
    # Equal sets link with the first document that has the set.
    copies = known.join(first.select("set_key", "first"), "set_key").filter("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    named = components(joined.unionByName(copies))
    return (sets.join(named.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group: the rows whose ``doc_id`` is its component's smallest (null ids stay)."""
    groups = near_duplicates(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    rows = set_aside(docs, ("doc_id", "text"))
    return rows.join(groups, "doc_id", "left_anti").select(*rows.columns).toDF(*docs.columns)
