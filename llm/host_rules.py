"""Quality rules with host verdicts (DataFrame functions only).

Every document gets base figures of its whole text and fails or passes a few
rules. Rule failures are added up by host (the ``source`` column); each
host's failure rates are shrunk towards the corpus by a beta prior fitted to
all hosts (moments of the beta-binomial, hosts weighted by their documents,
the spread that chance alone gives taken off). A host is rejected when it is
near certain that its rate passes the bound: when the rate's mean after its
documents, less ``HOST_TAIL`` standard deviations, does. The verdict goes back
to the documents over the host.

Defined cases: null or empty text has no words and fails the base rule; a
null host is a host of its own; an empty table gives no rows; repeated rows
are judged each for themselves (a row counts once per occurrence in its
host); columns beyond the named ones are ignored by ``judge`` and kept by
``keep_documents``, also where they are named like the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import set_aside, written

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A host is rejected when the share of its documents that fail a rule is beyond this, by so many standard deviations.
HOST_BOUND, HOST_TAIL = 0.6, 1.645
#: Least and largest weight of the prior, in documents.
PRIOR = (1.0, 1e6)

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["r_base", "r_symbols", "r_lines", "r_word_length"]


def _let(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once however often it is named."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))


def _windows(words: Column) -> Column:
    """A hash for each 8-word window."""
    def over(h: Column) -> Column:
        at = lambda i, j: F.get(h, i + j)
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[at(i, j) for j in range(WINDOW)]))
    return F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        _let(F.transform(words, lambda w: F.xxhash64(w)), over))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that are there more than once."""
    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = _let(placed, lambda p: F.transform(
            F.filter(p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])),
            lambda x: x["i"]))
        return _let(F.sort_array(starts), lambda s: F.aggregate(
            s, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"]))
    return _let(windows, lambda w: F.when(F.size(w) == F.size(F.array_distinct(w)), F.lit(0)).otherwise(covered(w)))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def with_figures(docs: DataFrame) -> DataFrame:
    """``docs`` and a struct column ``_figures`` with the five base figures."""
    text = F.coalesce(F.col("text"), F.lit(""))
    per_word = _let(_words(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(_windows(w)).alias("r")))
    return (docs.withColumn("_words", per_word)
            .withColumn("_figures", F.struct(
                F.col("_words.n").cast("long").alias("n_words"),
                _without(text, WHITE).cast("long").alias("word_chars"),
                (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
                _dup_lines(text).cast("long").alias("n_dup_lines"),
                F.col("_words.r").cast("long").alias("n_repeat_words")))
            .drop("_words"))


def _base_failed() -> Column:
    f = F.col("_figures")
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def _rules() -> dict[str, Column]:
    f = F.col("_figures")
    words = F.greatest(f["n_words"], F.lit(1))
    return {
        "r_base": _base_failed(),
        "r_symbols": 10 * f["n_symbols"] > f["word_chars"],
        "r_lines": 2 * f["n_dup_lines"] > words / 10,
        "r_word_length": (f["word_chars"] > 12 * words) | (f["word_chars"] < 2 * words),
    }


def host_rates(figured: DataFrame, host: str = "source") -> DataFrame:
    """A row per host: documents, and for each rule the shrunken failure rate.

    Prior of a rule: Beta(m k, (1 - m) k), with m the share of all documents
    that fail it. For H hosts of n of the N documents, failing at rate p, the
    sum of n (p - m)^2 is expected to be
    m (1 - m) (H - 1 + c (N - sum of n^2 / N - (H - 1))), with c = 1 / (k + 1)
    the correlation of two documents of a host. Hosts that agree more than
    chance allows, a lone host, and hosts of one document each, which tell
    nothing of c, get the largest k: all shrink to the mean.
    """
    rules = _rules()
    hosts = figured.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(k) for k, c in rules.items()])
    n = F.col("n").cast("double")
    moments = hosts.agg(
        F.sum(n).alias("docs"), F.sum(n * n).alias("squares"), F.count(F.lit(1)).alias("hosts"),
        *[x for k in rules for x in (F.sum(k).alias(f"x_{k}"), F.sum(F.col(k) * F.col(k) / n).alias(f"q_{k}"))])
    joined = hosts.crossJoin(F.broadcast(moments))  # one row of moments
    free = F.col("hosts") - 1
    between = F.col("docs") - F.col("squares") / F.col("docs") - free
    certain = []
    for k in rules:
        m = F.col(f"x_{k}") / F.col("docs")
        spread = F.col(f"q_{k}") - F.col("docs") * m * m
        c = F.when((between > 1e-9) & (m > 0) & (m < 1), F.try_divide(F.try_divide(spread, m * (1 - m)) - free, between))
        size = F.coalesce(F.when(c > 0, F.least(F.greatest(1 / c - 1, F.lit(PRIOR[0])), F.lit(PRIOR[1]))), F.lit(PRIOR[1]))
        joined = joined.withColumn(f"k_{k}", size).withColumn(f"p_{k}", (F.col(k) + m * F.col(f"k_{k}")) / (n + F.col(f"k_{k}")))
        p = F.col(f"p_{k}")
        certain.append(p - HOST_TAIL * F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / (n + F.col(f"k_{k}") + 1)))
    return joined.select("_host", F.col("n").alias("_host_docs"),
                         *[F.col(f"p_{k}").alias(f"_host_{k}") for k in rules],
                         (F.greatest(*certain) > HOST_BOUND).alias("_host_rejected"))


def judge(docs: DataFrame) -> DataFrame:
    """A row per document: the figures, ``base_failed``, ``kept`` and the host's rates."""
    narrow = written(with_figures(docs.select("doc_id", "source", "text")).drop("text"), "host-figures")
    hosts = host_rates(narrow)
    f = F.col("_figures")
    return (narrow.join(hosts, F.col("source").eqNullSafe(F.col("_host")), "left")
            .select("doc_id", *[f[k].alias(k) for k in FIGURES], _base_failed().alias("base_failed"),
                    (~_base_failed() & ~F.col("_host_rejected")).alias("kept"),
                    "source", *[F.round(f"_host_{k}", 6).alias(f"host_{k}") for k in RULES]))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The kept documents, with the columns of ``docs``."""
    rows = set_aside(docs, ("source", "text"))
    flagged = written(with_figures(rows), "host-figures")
    judged = flagged.join(host_rates(flagged), F.col("source").eqNullSafe(F.col("_host")), "left")
    return judged.filter(~_base_failed() & ~F.col("_host_rejected")).select(*rows.columns).toDF(*docs.columns)
