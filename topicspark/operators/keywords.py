"""Keyword index and keyphrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicspark.functions.text import keyword_map_json, render_keyword_map, tokens
from topicspark.operators.chunks import assign_chunks
from topicspark.session import scratch_path


def keyword_index(rows: DataFrame, chunk_size: int) -> DataFrame:
    """(topic, chunk, keyword, ids) -- sorted row ids of the chunk's rows
    carrying each keyword; duplicates kept. Rows without keywords add
    nothing. Each id list is bounded by the chunk size."""
    chunked = assign_chunks(rows.select("topic", "id", "keywords"), chunk_size)
    return (chunked.select("topic", "chunk", "id", F.explode("keywords").alias("keyword"))
                   .groupBy("topic", "chunk", "keyword")
                   .agg(F.sort_array(F.collect_list(F.col("id").cast("long"))).alias("ids")))


def keyword_maps(index: DataFrame) -> DataFrame:
    """F12 + F13 per chunk: (topic, chunk, keyword_map, keyword_json)."""
    per_chunk = index.groupBy("topic", "chunk").agg(
        F.collect_list(F.struct("keyword", "ids")).alias("entries"))
    return per_chunk.select("topic", "chunk", render_keyword_map("entries").alias("keyword_map"),
                            keyword_map_json("entries").alias("keyword_json"))


#: Tokens whose phrases are counted at a time (a row is never cut).
SLICE_TOKENS = 500_000
#: Tokens of a block of rows, whose phrases are written as one list (a row is never cut).
BLOCK_TOKENS = 1_000_000
#: Tokens for each of the parts in which the lists of all blocks are added up.
BUCKET_TOKENS = 2_000_000


def _row_phrases():
    """Function: (word of each token as a number below ``kinds``, tokens of
    each row) -> (phrase, row, tf) of the distinct 1- and 2-word phrases of
    each row, by phrase, then row. A phrase is first * (kinds + 1) + second,
    where second is 0 for one word, else the number of the second word plus 1:
    with words numbered in order this is the order of the phrases' text, as a
    space sorts before every character of a word."""
    def phrases(code, size, kinds):
        import numpy as np

        rows = max(len(size), 1)
        row = np.repeat(np.arange(len(size), dtype=np.int32), size)
        pair = row[1:] == row[:-1]
        two = (code[:-1][pair] * (kinds + 1) + code[1:][pair] + 1) * rows + row[:-1][pair]
        at = np.concatenate([code * (kinds + 1) * rows + row, two])
        del row, pair, two  # the largest arrays of a block go as soon as they can
        at.sort()
        new = np.flatnonzero(np.append([True][:len(at)], at[1:] != at[:-1]))
        tf = np.diff(new, append=len(at))
        at = at[new]
        return at // rows, (at % rows).astype(np.int32), tf

    return phrases


def _phrase_counts():
    """Arrow function: the tokens of a row -> its distinct 1- and 2-word
    phrases with their counts. One nested function, for executors without this
    package."""
    slice_tokens, found_in = SLICE_TOKENS, _row_phrases()

    def counts(rows):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def counted(words, size):
            """(phrase, tf, phrases of each row) of rows of ``size`` tokens."""
            coded = words.dictionary_encode()
            kinds = len(coded.dictionary)
            phrase, row, tf = found_in(coded.indices.to_numpy().astype(np.int64), size, kinds)
            first, second = np.divmod(phrase, kinds + 1)
            order = np.lexsort((second > 0, row))
            ends = pa.concat_arrays([pa.array([""], words.type), pc.binary_join_element_wise("", coded.dictionary, " ")])
            names = pc.binary_join_element_wise(coded.dictionary.take(pa.array(first[order])), ends.take(pa.array(second[order])), "")
            return names, tf[order], np.bincount(row, minlength=len(size))

        size = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        words, ends = rows.flatten(), np.cumsum(size)
        done, parts = 0, [(pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while done < len(size):
            low = int(ends[done - 1]) if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, low + slice_tokens, side="right")))
            parts.append(counted(words.slice(low, int(ends[stop - 1]) - low), size[done:stop]))
            done = stop
        phrase, tf, each = zip(*parts)
        cuts = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(each))]), pa.int32())
        found = pa.StructArray.from_arrays([pa.concat_arrays(phrase), pa.array(np.concatenate(tf), pa.int64())], names=["phrase", "tf"])
        return pa.ListArray.from_arrays(cuts, found)

    return F.arrow_udf(counts, "array<struct<phrase: string, tf: bigint>>")


def _phrase_steps(top: int, n_rows: int, buckets: int):
    """Arrow functions of ``keyphrases``: (rows -> blocks, blocks -> phrase
    lists, lists of a bucket -> frequencies, blocks with frequencies -> best
    phrases). Nested functions, for executors without this package."""
    block_tokens, found_in = BLOCK_TOKENS, _row_phrases()

    def pack(data):
        import pyarrow as pa
        return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)

    def unpack(data):
        import pyarrow as pa
        return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)

    def pack_numbers(values):
        """The first bytes of all numbers, then the second bytes, ..."""
        import numpy as np
        return pack(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())

    def unpack_numbers(data):
        import numpy as np
        return np.frombuffer(unpack(data), np.uint8).reshape(8, -1).T.copy().view("<i8").reshape(-1)

    def lines(data):
        """The lines of a text, each with its line break."""
        import numpy as np
        import pyarrow as pa
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
        cuts = np.concatenate([np.zeros(1, np.int64), ends])
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(data)])

    def one_by_one(batch):
        """The rows of a batch; what one took is given back to the system before the next."""
        import ctypes

        import pyarrow as pa

        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            pa.default_memory_pool().release_unused()
            if trim is not None:
                trim(0)

    def coded(batches):
        """(key..., tokens) -> a block's keys, tokens of each row, word of each token, words in order."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32

        def block(held):
            keys, size, words = zip(*held)
            keys, size, words = pa.concat_arrays(keys), np.concatenate(size), pa.concat_arrays(words).dictionary_encode()
            order = pc.sort_indices(words.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            text = "".join(w + "\n" for w in words.dictionary.take(pa.array(order)).to_pylist()).encode()
            return pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), pa.array([len(size)], pa.int64()), pa.array([int(size.sum())], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                 *(pa.array([x], pa.binary()) for x in (pack_numbers(size), pack_numbers(place[words.indices.to_numpy()]), pack(text)))],
                names=["block", "rows", "tokens", "keys", "sizes", "codes", "words"])

        held, room = [], block_tokens
        for batch in batches:
            keys = pa.StructArray.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            size = batch.column(batch.num_columns - 1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            words, at = batch.column(batch.num_columns - 1).flatten(), np.concatenate([[0], np.cumsum(size)])
            cost, done = at + np.arange(len(at)), 0  # a row without tokens takes room too
            while done < len(size):
                stop = max(done + (not held), int(np.searchsorted(cost, cost[done] + room, side="right")) - 1)
                if stop > done:
                    held.append((keys.slice(done, stop - done), size[done:stop], words.slice(int(at[done]), int(at[stop] - at[done]))))
                    room -= int(cost[stop] - cost[done])
                    done = stop
                if done < len(size):
                    yield block(held)
                    made, held, room = made + 1, [], block_tokens
        if held:
            yield block(held)

    def opened(block):
        """Its (words, first word, second word and rows of each phrase, places of the phrases by bucket, phrases of each bucket, row, tf)"""
        import zlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = pc.utf8_slice_codeunits(lines(unpack(block["words"])).view(pa.large_string()), 0, -1)
        kinds, size = len(words), unpack_numbers(block["sizes"])
        phrase, row, tf = found_in(unpack_numbers(block["codes"]), size, kinds)
        starts = np.flatnonzero(np.append([True][:len(phrase)], phrase[1:] != phrase[:-1]))
        held, phrase = np.diff(starts, append=len(phrase)), phrase[starts]
        first, second = phrase // (kinds + 1), phrase % (kinds + 1)
        del starts, phrase
        # The same words have the same bucket in every block; which one it is makes no difference.
        mark = np.fromiter(map(zlib.crc32, words.view(pa.large_binary()).to_pylist()), np.uint64, kinds)
        mixed = mark[first] * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([np.zeros(1, np.uint64), mark])[second]
        bucket = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(buckets)
        bucket = bucket.astype(np.int32)
        return words, first, second, held, np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=buckets), row, tf

    def names(words, first, second, end):
        """The phrases' texts, each with ``end`` behind it."""
        import pyarrow as pa
        import pyarrow.compute as pc

        joined = lambda *parts: pc.binary_join_element_wise(*(pa.scalar(x, words.type) if isinstance(x, str) else x for x in (*parts, "")))
        ends = pa.concat_arrays([pa.array([end], words.type), joined(" ", words, end)])
        return joined(words.take(pa.array(first)), ends.take(pa.array(second)))

    def listed(batches):
        """blocks -> (bucket, block, phrases, the block's rows that have each)."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for block in one_by_one(batch):
                words, first, second, held, order, each = opened(block)[:6]
                text = names(words, first[order], second[order], "\n")
                at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:][:len(text) + 1] if len(text) else np.zeros(1, np.int64)
                held, cuts, some = held[order], np.concatenate([[0], np.cumsum(each)]), np.flatnonzero(each)
                data = memoryview(text.buffers()[2]) if len(text) else b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([block["block"]] * len(some), pa.int64()),
                     pa.array([pack(bytes(data[at[cuts[i]]:at[cuts[i + 1]]])) for i in some], pa.binary()),
                     pa.array([pack_numbers(held[cuts[i]:cuts[i + 1]]) for i in some], pa.binary())],
                    names=["bucket", "block", "phrases", "held"])

    def added(table):
        """The lists of a bucket -> (block, bucket, rows of the whole table that have each phrase of the block's list)."""
        import numpy as np
        import pyarrow as pa

        held = [unpack_numbers(x) for x in table["held"].to_pylist()]
        text = lines(b"".join(unpack(x) for x in table["phrases"].to_pylist())).dictionary_encode().indices.to_numpy()
        total = np.bincount(text, weights=np.concatenate(held)).astype(np.int64)[text]
        cuts = np.cumsum([0, *map(len, held)])
        return pa.table({"block": table["block"], "bucket": table["bucket"],
                         "dfs": pa.array([pack_numbers(total[x:y]) for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())})

    def best(batches):
        """blocks with their frequencies -> (key..., phrase, tf, df): for each row its ``top`` best, and those
        that rounding could put among them."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at, block in enumerate(one_by_one(batch.drop_columns(["keys"]))):
                words, first, second, held, order, _, row, tf = opened(block)
                df = np.empty(len(order), np.int64)
                df[order] = np.concatenate([unpack_numbers(x["dfs"]) for x in sorted(block["dfs"], key=lambda x: x["bucket"])])
                phrase = np.repeat(np.arange(len(df), dtype=np.int32), held)
                score = (np.log((1 + n_rows) / (1 + df)) + 1)[phrase]
                score *= tf
                keys = batch.column("keys")[at].values
                by_row = np.lexsort((-score, row))
                starts = np.searchsorted(row[by_row], np.arange(len(keys) + 1))
                least, last = np.full(len(keys), -np.inf), starts[:-1] + top - 1
                full = last < starts[1:]
                least[full] = score[by_row[last[full]]]
                near = np.flatnonzero(score >= (least - 1e-8 - 1e-9 * np.abs(least))[row])
                # Of a row's phrases with one score only the first ``top`` by text can be among its best.
                near = near[np.lexsort((phrase[near], df[phrase[near]], tf[near], row[near]))]
                same = np.stack([row[near], tf[near], df[phrase[near]]])
                begin = np.flatnonzero(np.append(True, (same[:, 1:] != same[:, :-1]).any(0))[:len(near)])
                near = near[np.arange(len(near)) - np.repeat(begin, np.diff(begin, append=len(near))) < top]
                which = phrase[near]
                yield pa.RecordBatch.from_arrays(
                    [*keys.take(pa.array(row[near])).flatten(), names(words, first[which], second[which], "").cast(pa.string()),
                     pa.array(tf[near], pa.int64()), pa.array(df[which], pa.int64())],
                    names=[*(f.name for f in keys.type), "phrase", "tf", "df"])

    return coded, listed, added, best


def keyphrases(docs: DataFrame, key: list[str], text: str, top: int = 5) -> DataFrame:
    """Top ``top`` 1- and 2-word phrases per row by corpus TF-IDF:
    score = tf * (ln((1 + N) / (1 + df)) + 1), N = rows, df = rows holding
    the phrase; ties by phrase. A stand-in for the embedding-model extractor
    of the original: the scores are not comparable to its scores.

    Texts are tokenised once and written as blocks of rows: the words of a
    block in order, and for each token the number of its word. A block sends
    each of its distinct phrases once, with the number of its rows that have
    it, to the bucket of the phrase; the bucket adds these up over all blocks
    and sends each block the frequencies of its own phrases, in the order in
    which it sent them. With these a block scores all phrases of its rows, and
    only the best of each row leave it. So no phrase is moved for a row, one
    present in most rows comes once from a block, and what is written and
    shuffled is about the size of the texts.

    The join of the blocks with their frequencies is keyed by block; both
    sides come from files and end in a shuffle of their own, which is what the
    adaptive skew-join split needs."""
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "phrases")
    keys = T.StructType([T.StructField(k, docs.schema[k].dataType) for k in key])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("tokens", T.LongType()),
                           T.StructField("keys", T.ArrayType(keys)), *(T.StructField(c, T.BinaryType()) for c in ("sizes", "codes", "words"))])
    toks = (docs.select(*key, text).repartition(n_parts, *[F.col(k) for k in key])
                .select(*key, tokens(text).alias("_toks")))
    _write_and_free(toks.mapInArrow(_phrase_steps(top, 0, 1)[0], schema), path + "/blocks")
    blocks = spark.read.schema(schema).parquet(path + "/blocks")
    total = blocks.agg(F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens")).first()
    n = total["rows"] or 0
    _, listed, added, best = _phrase_steps(top, n, 1 + (total["tokens"] or 0) // BUCKET_TOKENS)
    lists = blocks.select("block", "sizes", "codes", "words").mapInArrow(listed, "bucket int, block long, phrases binary, held binary")
    counted = lists.groupBy("bucket").applyInArrow(added, "block long, bucket int, dfs binary")
    _write_and_free(counted.groupBy("block").agg(F.collect_list(F.struct("bucket", "dfs")).alias("dfs")), path + "/df")
    dfs = spark.read.schema("block long, dfs array<struct<bucket: int, dfs: binary>>").parquet(path + "/df")
    found = blocks.select("block", "keys", "sizes", "codes", "words").join(dfs, "block").mapInArrow(
        best, T.StructType([*keys, T.StructField("phrase", T.StringType()), T.StructField("tf", T.LongType()), T.StructField("df", T.LongType())]))
    ranks = Window.partitionBy(*key).orderBy(F.round("score", 9).desc(), "phrase")
    return (found.withColumn("score", F.col("tf") * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1))
                 .withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= top)
                 .select(*key, "rank", "phrase", "score"))


#: Removes a query's shuffle files when it ends (a setting of Spark 4.1).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write_and_free(df: DataFrame, path: str) -> None:
    """Write a table whose rows can be several MB: a file's row groups and
    pages stay small. The query's shuffles are freed when it ends, so that the
    disk holds those of one step only."""
    spark = df.sparkSession
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        (df.write.option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 1)
           .option("parquet.page.size.row.check.min", 1).parquet(path))
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def keyword_chunks(rows: DataFrame, chunk_size: int) -> DataFrame:
    """A10 with F13: (topic, chunk, chunk_start, chunk_end, keyword_json) of
    every chunk, ``keyword_json`` null where it has no keywords.

    Bounds and keywords come from the same rows in one pass: a row without
    keywords stays as one with a null keyword, so that no join of the chunks
    with their maps is planned, on either side of which a broadcast would have
    to hold all chunks."""
    chunked = assign_chunks(rows.select("topic", "id", "keywords"), chunk_size)
    words = F.when(F.size("keywords") > 0, F.col("keywords"))
    id_ = F.col("id").cast("long")
    held = (chunked.select("topic", "chunk", "id", F.posexplode_outer(words).alias("_at", "keyword"))
                   .groupBy("topic", "chunk", F.col("_at").isNull().alias("_none"), "keyword")
                   .agg(F.min(id_).alias("_lo"), F.max(id_).alias("_hi"), F.sort_array(F.collect_list(id_)).alias("ids")))
    entry = F.when(~F.col("_none"), F.struct("keyword", "ids"))
    per = held.groupBy("topic", "chunk").agg(F.min("_lo").alias("chunk_start"), F.max("_hi").alias("chunk_end"),
                                             F.collect_list(entry).alias("entries"))
    return per.select("topic", "chunk", "chunk_start", "chunk_end",
                      F.when(F.size("entries") > 0, keyword_map_json("entries")).alias("keyword_json"))


# The prompt header of the chunk summary request.
PROMPT_HEAD = ("Summarize the following data by bullets like this:\n"
               "- [70 % ] Data 1\n"
               "- [20 % ] Data 2,\n"
               "...\n"
               "Below are ")
PROMPT_TAIL = " data needed to summarize :\n "


def chunk_prompts(articles: DataFrame, chunk_size: int) -> DataFrame:
    """One prompt text per chunk for offline batch inference: the fixed
    header, then per row in id order ``id answer question kw1 kw2 ...  epoch``
    and a newline. The prompt is bounded by the chunk size."""
    chunked = assign_chunks(articles, chunk_size)
    line = F.concat(
        F.col("id").cast("string"), F.lit(" "), F.coalesce("answer", F.lit("")), F.lit(" "),
        F.coalesce("question", F.lit("")), F.lit(" "),
        F.array_join(F.transform(F.coalesce("keywords", F.array().cast("array<string>")),
                                 lambda k: F.concat(k, F.lit(" "))), ""),
        F.lit(" "), F.unix_timestamp("updatedAt").cast("string"), F.lit("\n"))
    per = chunked.groupBy("topic", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("id").cast("long").alias("id"), line.alias("l")))),
                                 lambda s: s["l"]), "").alias("data"))
    return per.select("topic", "chunk", F.concat(F.lit(PROMPT_HEAD), F.lit(str(chunk_size)),
                                                 F.lit(PROMPT_TAIL), F.col("data")).alias("prompt"))
