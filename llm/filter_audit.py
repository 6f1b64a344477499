"""Filter interaction audit with wide packed counters.

Five filters A to E are applied to every document, and for all 120 orders of
them the audit tells what each step removes. A document is its mask of failed
filters. ``outcomes`` maps a mask to one big integer that holds a 64-bit field
for each outcome of each of the 600 steps (removed here, removed earlier
though it fails here, removed with a good label, removed with a toxic label),
and one for the document itself. Adding these integers counts all outcomes at
once: tasks add one per distinct (text, part, labels), weighted by its
documents, and send one integer per part on; those meet first by (part, salt),
then by part. A field counts documents of a table, so it stays under 2**63 and
never runs over into the next one.

Spark finds the masks: A to D from each whole text by built-in functions, E
from the smallest doc_id of each text (SHA-256), where equal texts are added up
before they meet.

Filters (a document fails): A under 200 words; B 100 * distinct words < 50 *
words; C 100 * capitals A-Z > 3 * code points; D holds one of ``#$%&*|``; E
identical to the text of a smaller doc_id. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined cases: a null text is empty (it fails A, and E after the first empty
one); a null lang is the part ``""``; a null doc_id is neither smaller nor
larger than any other, so it neither fails E nor makes others fail; rows that
repeat a doc_id count each, and none of them fails E by the other; a document
is good (toxic) if any of its label rows has quality (toxic) 1; an empty table
gives no rows; columns beyond the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import releasing, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS = 200
SYMBOLS = "#$%&*|"
WORD_END = "[ \\t\\n\\x0B\\f\\r]+"
WHITE = " \t\n\x0b\x0c\r"
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)

#: Bytes of a counter, and what is counted of each step.
FIELD = 8
KINDS = ("removed", "redundant", "good_lost", "toxic_lost")
STEPS = len(ORDERS) * len(FILTERS)
FIELDS = STEPS * len(KINDS) + 1
#: Parts whose integers a task holds before it hands them on, and groups in which the integers of a part meet first.
PARTS_HELD, SALTS = 500, 64


def _text_mask(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    words = F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, WORD_END))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    counted = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    bits = F.transform(F.array(counted), lambda c: (
        (c["n"] < MIN_WORDS).cast("int") + 2 * (100 * c["d"].cast("long") < 50 * c["n"].cast("long")).cast("int")))[0]
    return (bits + 4 * (100 * capitals.cast("long") > 3 * F.length(text).cast("long")).cast("int")
            + 8 * text.rlike("[" + SYMBOLS + "]").cast("int"))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, key, n): documents of each part and key, not added up over texts. ``key`` is the mask of failed
    filters (A lowest) with the bits ``GOOD`` and ``TOXIC``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), _text_mask(text).alias("mask"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic"))
    rows = read.join(marks, "doc_id", "left").select(
        "doc_id", "part", "digest",
        (F.col("mask") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))).alias("key"))
    # One row per document first, so that the smallest doc_id of a group comes with its own rows.
    ids = rows.groupBy("doc_id", "part", "digest", "key").agg(F.count(F.lit(1)).alias("n"))
    texts = written(ids.groupBy("digest", "part", "key").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")), "filter-texts")
    least = texts.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    held = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = texts.join(least, "digest").select("part", F.explode(F.array(
        F.struct(F.col("key"), held.alias("n")),
        F.struct((F.col("key") + 16).alias("key"), (F.col("n") - held).alias("n")))).alias("x"))
    return both.select("part", "x.key", "x.n").filter("n > 0")


def outcomes(key: int) -> int:
    """The big integer of a document with this key: a field is 1 where its outcome holds."""
    fields = bytearray(FIELD * FIELDS)
    fields[FIELD * (FIELDS - 1)] = 1
    for o, order in enumerate(ORDERS):
        gone = False
        for s, name in enumerate(order):
            if key >> FILTERS.index(name) & 1:
                at = FIELD * len(KINDS) * (o * len(FILTERS) + s)
                fields[at + FIELD * gone] = 1
                if not gone:
                    fields[at + FIELD * 2], fields[at + FIELD * 3] = bool(key & GOOD), bool(key & TOXIC)
                gone = True
    return int.from_bytes(fields, "little")


def _batch(columns: dict, types: dict):
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in types.items()], names=list(types))


def _sent(held: dict, salt: int):
    return _batch({"part": list(held), "salt": [salt] * len(held),
                   "total": [x.to_bytes(FIELD * FIELDS, "little") for x in held.values()]},
                  {"part": pa.string(), "salt": pa.int32(), "total": pa.binary()})


def _add_rows(batches):
    from pyspark import TaskContext

    salt = TaskContext.get().partitionId() % SALTS
    big: dict[int, int] = {}
    held: dict[str, int] = {}
    for batch in batches:
        for part, key, n in zip(*(batch.column(k).to_pylist() for k in ("part", "key", "n")), strict=True):
            if key not in big:
                big[key] = outcomes(key)
            held[part] = held.get(part, 0) + n * big[key]
            if len(held) > PARTS_HELD:
                yield _sent(held, salt)
                held = {}
    if held:
        yield _sent(held, salt)


# Spark hands over a group batch by batch where the annotations say so.
Key, Batches = tuple[pa.Scalar, ...], Iterator[pa.RecordBatch]


def _add(batches: Batches) -> int:
    return sum(int.from_bytes(x.as_py(), "little") for batch in batches for x in batch.column("total"))


def _meet(key: Key, batches: Batches) -> Batches:
    yield _sent({key[0].as_py(): _add(batches)}, 0)


def _unpack(key: Key, batches: Batches) -> Batches:
    fields = np.frombuffer(_add(batches).to_bytes(FIELD * FIELDS, "little"), "<i8")
    steps = fields[:-1].reshape(len(ORDERS), len(FILTERS), len(KINDS))
    removed = steps[:, :, 0]
    letters = np.array([[FILTERS.index(x) for x in order] for order in ORDERS])
    last = np.zeros(len(FILTERS), "i8")
    last[letters[:, -1]] = removed[:, -1]  # what only the last step removes fails no other filter
    whole = np.zeros(len(FILTERS), "i8")
    np.add.at(whole, letters, removed)
    part = key[0].as_py()
    columns = {"part": [part] * STEPS, "filter_order": np.repeat(ORDERS, len(FILTERS)),
               "step": np.tile(np.arange(1, 6), len(ORDERS)), "kept": fields[-1] - removed.cumsum(axis=1),
               **{k: steps[:, :, i] for i, k in enumerate(KINDS)}, "unique_fails": last[letters], "shapley": whole[letters]}
    kinds = {k: pa.string() if k in ("part", "filter_order") else pa.int32() if k == "step" else pa.int64() for k in columns}
    yield _batch({k: v if isinstance(v, list) else v.ravel() for k, v in columns.items()}, kinds)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order and step: ``kept`` after it, ``removed`` by it, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost`` and ``shapley`` (removed by its filter over all orders)."""
    sums = "part string, salt int, total binary"
    mine = masks(docs, labels).mapInArrow(releasing(_add_rows), sums)
    return (mine.groupBy("part", "salt").applyInArrow(_meet, sums)
            .groupBy("part").applyInArrow(_unpack, (
                "part string, filter_order string, step int, kept long, removed long, redundant long, good_lost long, "
                "toxic_lost long, unique_fails long, shapley long")))
