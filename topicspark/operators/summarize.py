"""Extractive summary per row.

The sentence ranker of the original system is not available, so the
definition is our own, after LexRank (Erkan & Radev 2004, degree form) and
TextRank (Mihalcea & Tarau 2004):

1. text = question + newline + answer; sentences end at ``.``, ``!`` or
   ``?`` followed by whitespace, or at a newline; trimmed, blanks dropped.
2. term weight = tf * (ln((1 + n) / (1 + df)) + 1), n = sentences of the
   row, df = sentences of the row holding the term; each sentence vector is
   L2-normalised.
3. ``degree``: score_i = sum_j cos(i, j) = s_i . (sum_j s_j) -- one dot
   product with the row's summed vector, never a sentence pair.
   ``textrank``: r <- 0.15/n + 0.85 * S (S^T (r / deg)), a fixed number of
   rounds, again without pairs.
4. the top ``k`` sentences by (round(score, 9) desc, position) are emitted
   in position order joined by one space; a row without text gives ''.

A summary needs its own row alone. Rows are spread by their key once; Spark
cuts and tokenises the text, and an Arrow function takes the tokens of a batch
of rows and gives the places of the picked sentences. No token becomes a row,
so nothing is sorted or held per token beyond a slice of a batch, and a query
that does not read the summaries does not make them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicspark.functions.text import qa_text, tokens

SENTENCE_BREAK = r"([.!?])\s+"
METHODS = ("degree", "textrank")
#: Tokens that the ranking holds as numbers at a time (a row is never cut).
SLICE_TOKENS = 500_000


def _picks(method: str, top: int, rounds: int = 10, damping: float = 0.85):
    """Arrow function: the tokens of each sentence of a row -> the places
    (from 0, ascending) of the row's ``top`` best sentences.

    Its body is one nested function, so that it reaches executors that do not
    have this package."""
    slice_tokens = SLICE_TOKENS

    def pick(rows):
        import numpy as np
        import pyarrow as pa

        def ranked(sentences, per_row):
            """The places of the picked sentences, and how many each row has."""
            n_rows, n_sent = len(per_row), len(sentences)
            row = np.repeat(np.arange(n_rows), per_row)
            first = np.cumsum(per_row) - per_row
            words = sentences.flatten().dictionary_encode()
            kinds = max(len(words.dictionary), 1)
            at = np.repeat(np.arange(n_sent), np.diff(sentences.offsets.to_numpy()))
            # One entry per (sentence, term); ``own`` numbers the (row, term) it belongs to.
            entry, tf = np.unique(at * kinds + words.indices.to_numpy(), return_counts=True)
            sent, term = entry // kinds, entry % kinds
            _, own, df = np.unique(row[sent] * kinds + term, return_inverse=True, return_counts=True)
            w = tf * (np.log((1.0 + per_row[row[sent]]) / (1.0 + df[own])) + 1.0)
            sv = w / np.sqrt(np.bincount(sent, w * w, n_sent))[sent]
            score = np.bincount(sent, sv * np.bincount(own, sv)[own], n_sent)
            if method == "textrank":
                degree, n = score, per_row[row].astype(float)
                score = 1.0 / n
                for _ in range(rounds):
                    x = np.divide(score, degree, out=np.zeros(n_sent), where=degree > 0)
                    back = np.bincount(own, sv * x[sent])
                    score = (1.0 - damping) / n + damping * np.bincount(sent, sv * back[own], n_sent)
            order = np.lexsort((np.arange(n_sent), -np.round(score, 9), row))
            best = np.sort(order[np.arange(n_sent) - first[row] < top])  # ``order`` keeps each row's places together
            return best - first[row[best]], np.minimum(per_row, top)

        lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        sentences = rows.flatten()
        ends = np.cumsum(lengths)  # of rows, in sentences
        offsets = np.asarray(sentences.offsets) if len(sentences) else np.zeros(1, np.int64)
        before = offsets[ends] - offsets[0]  # tokens up to the end of each row
        places, counts, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while start < len(lengths):
            done = before[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(before, done + slice_tokens, side="right")))
            low = int(ends[start - 1]) if start else 0
            part = sentences.slice(low, int(ends[stop - 1]) - low)
            chosen, each = ranked(part, lengths[start:stop])
            places.append(chosen)
            counts.append(each)
            start = stop
        cuts = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(places), pa.int32()))

    return F.arrow_udf(pick, "array<int>")


def summarize(df: DataFrame, key: list[str], question: str = "question",
              answer: str = "answer", top: int = 3, method: str = "degree",
              out: str = "summary") -> DataFrame:
    """One row per key: (key, summary). (Of rows that share a key, the
    summary that sorts last stays.)"""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    # An explicit partition count: the text is small in bytes next to the work
    # on it, so the exchange must not be coalesced down to a few tasks by
    # input size.
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = (df.select(*key, qa_text(question, answer).alias("_text"))
              .repartition(n_parts, *[F.col(k) for k in key]))
    pieces = F.transform(F.split(F.regexp_replace("_text", SENTENCE_BREAK, "$1\n"), "\n"), lambda x: F.trim(x))
    picked = (base.select(*key, F.filter(pieces, lambda x: x != "").alias("_sentences"))
                  .withColumn("_tokens", F.transform("_sentences", lambda x: tokens(x)))
                  .withColumn("_picks", _picks(method, top)("_tokens")))
    text = F.array_join(F.transform("_picks", lambda i: F.get("_sentences", i)), " ")
    return picked.select(*key, text.alias(out)).groupBy(*key).agg(F.max(out).alias(out))
