"""Mixing to target weights by soft memberships.

A multinomial classifier, fitted on a bounded sample of a labelled table,
gives every document the posterior of each domain. A document's expected
tokens of a domain are its tokens times that posterior. Rates r >= 0 (how
often a document is taken) start at 1 and follow projected gradient steps of
the least squares

    f(r) = sum over domains k of (total_k - T_k)^2 / T_k / 2,
    total_k = sum over documents i of tokens_i p_ik r_i

A step lowers every rate by p_i . s, with one vector s of domains for all
documents, and cuts it off at 0, so the rates are known from the list of
steps and a document's own posterior. Each round is one pass over a narrow
table. It tries the gradient of f at the length that is sure to descend and
at a few longer ones, and the gradient times the inverse of the Gram matrix
of the rows above 0, with which scarce domains move as fast as others; the
best of them by f is taken. Rounds end when every total is within
``TOLERANCE`` / 10 of its target, or when the projected gradient moves the
rates by less than ``STILL``: then no rates meet the targets, f is at its
least, a warning names the domains that miss, and ``Mixer.missed`` holds by
how much.

A rate is realised as floor(r + u) copies, u being a hash of the row: the
expected number of copies is the rate, and a run repeats exactly.

The budget (sum of the T_k) is given, or by default the least at which no
domain but those in ``reduce`` has to lose tokens, so that only these are
thinned out and the others are repeated.

Defined cases: null or empty text has no tokens; its rate is 1 like that of
a document in balance. Domains without any tokens are left out and the
weights of the others scaled up. Without labelled documents every domain has
the same posterior; with one class it has posterior 1. Repeated rows count
each for themselves. Extra columns are kept by ``mixed``.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import text_stats
from llm.tables import set_aside, written

#: Bound of the training sample, in labelled rows.
MAX_TRAIN = 8_000
TOLERANCE = 1e-4
#: Root mean square (by tokens) of what a sure gradient step moves the rates by, at which f counts as least.
STILL = 1e-7
#: Lengths tried in one pass: of the gradient, in lengths that surely descend, and of the gradient times the inverse Gram matrix.
PLAIN, SCALED = (1.0, 4.0, 16.0, 64.0, 256.0), (1.0, 0.5, 0.2, 0.05)


def sample_of(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(x, domain) of at most MAX_TRAIN labelled documents, written."""
    chosen = (labelled.filter("doc_id is not null and domain is not null").select(F.col("doc_id").alias("_id"), "domain")
              .orderBy(F.xxhash64("_id"), "_id", "domain").limit(MAX_TRAIN))
    rows = text_stats.with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "domain"))
    return written(rows.select("doc_id", "domain", F.col("_stats").alias("x")), "mixing-sample")


class Posterior:
    """Domain posteriors of documents with a ``_stats`` column."""

    def __init__(self, sample: DataFrame, domains: list[str]):
        self.domains = domains
        known = {r[0] for r in sample.select("domain").filter(F.col("domain").isin(domains)).distinct().collect()}
        self.known = [d for d in domains if d in known]
        self.model = None
        if len(self.known) > 1:
            index = F.array_position(F.array(*[F.lit(d) for d in self.known]), F.col("domain")) - 1
            rows = sample.filter(F.col("domain").isin(self.known)).select(
                array_to_vector("x").alias("features"), index.cast("double").alias("label"))
            self.model = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60).fit(rows)

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` and ``_p``, an array in the order of the domains."""
        if self.model is None:
            p = [1.0 if d in self.known else 0.0 for d in self.domains] if self.known else [1.0 / len(self.domains)] * len(self.domains)
            return df.withColumn("_p", F.array(*[F.lit(x) for x in p]))
        scored = self.model.setFeaturesCol("_features").setProbabilityCol("_prob").setPredictionCol("_pred").setRawPredictionCol("_raw").transform(
            df.withColumn("_features", array_to_vector("_stats")))
        prob = vector_to_array("_prob")
        return (scored.withColumn("_p", F.array(*[prob[self.known.index(d)] if d in self.known else F.lit(0.0) for d in self.domains]))
                .drop("_features", "_prob", "_pred", "_raw"))


def _rates(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    r = np.ones(len(p))
    for s in steps:
        np.maximum(r - p @ s, 0, out=r)
    return r


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _totals(narrow: DataFrame, steps: np.ndarray, tried: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each step tried after ``steps``: expected tokens of each domain, the Gram matrix of the rows above 0, sum of tokens (change of r)^2."""
    k = tried.shape[1]

    def run(batches):
        sums = np.zeros((len(tried), k + k * k + 1))
        for b in batches:
            p, tokens = _matrix(b.column(0), k), b.column(1).to_numpy(zero_copy_only=False).astype(float)
            old = _rates(p, steps)
            for at, s in enumerate(tried):
                r = np.maximum(old - p @ s, 0)
                above = p * (tokens * (r > 0))[:, None]
                sums[at] += np.concatenate([(tokens * r) @ p, (p.T @ above).ravel(), [(tokens * (r - old) ** 2).sum()]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])
    # One short row a task: added up on the executors.
    parts = narrow.select("_p", "_stats_words").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "x"))
    values = np.zeros(len(tried) * (k + k * k + 1))
    for row in parts.groupBy("at").agg(F.sum("x").alias("x")).collect():
        values[row["at"]] = row["x"]
    return [(v[:k], v[k:-1].reshape(k, k), float(v[-1])) for v in values.reshape(len(tried), -1)]


def descend(narrow: DataFrame, weights: list[float], reduce: list[int], budget: float | None = None):
    """(the steps taken, a row each; expected totals; targets)."""
    k = len(weights)
    steps = np.zeros((0, k))
    now, gram, _ = _totals(narrow, steps, np.zeros((1, k)))[0]
    tokens = now.sum()
    w = np.where(now > 0, np.array(weights, float), 0)
    if not w.sum():
        return steps, now, now
    w /= w.sum()
    keep = [i for i in range(k) if i not in reduce and w[i] > 0]
    if budget is None:
        budget = max(now[i] / w[i] for i in keep) if keep else tokens
    target = budget * w
    unit = np.maximum(target, tokens * 1e-6)
    root = np.sqrt(unit)
    # The rates' largest curvature of f: a gradient step of 1 / steepest always descends.
    steepest = np.linalg.eigvalsh(gram / np.outer(root, root))[-1]
    while np.abs(miss := (now - target) / unit).max() > TOLERANCE / 10:
        scaled = np.linalg.pinv(gram / np.outer(root, root), rcond=1e-9, hermitian=True) @ (miss * root) / root
        tried = np.concatenate([np.outer(PLAIN, miss / steepest), np.outer(SCALED, scaled)])
        sums = _totals(narrow, steps, tried)
        values = [((x - target) ** 2 / unit).sum() for x, _, _ in sums]
        best = int(np.argmin(values))
        if sums[0][2] < STILL ** 2 * tokens or not values[best] < ((now - target) ** 2 / unit).sum():
            break
        steps, (now, gram, _) = np.concatenate([steps, tried[best:best + 1]]), sums[best]
    return steps, now, target


def missed(domains: list[str], reached: np.ndarray, targets: np.ndarray) -> dict[str, float]:
    """Relative misses beyond TOLERANCE by domain; a warning names them."""
    unit = np.maximum(targets, max(targets.sum(), 1.0) * 1e-6)
    out = {d: float(x) for d, x in zip(domains, (reached - targets) / unit) if abs(x) > TOLERANCE}
    if out:
        warnings.warn("mixing misses its targets: " + ", ".join(f"{d} {x:+.2%}" for d, x in out.items()), stacklevel=3)
    return out


def _rate(steps: np.ndarray) -> Column:
    """The rate that the steps lead to from 1, as a column over ``_p``."""
    p = F.col("_p")
    def step(r: Column, s: Column) -> Column:
        taken = F.lit(0.0)
        for i in range(steps.shape[1]):
            taken = taken + p[i] * s[i]
        return F.greatest(F.lit(0.0), r - taken)
    if not len(steps):
        return F.lit(1.0)
    return F.aggregate(F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps]), F.lit(1.0), step)


def _copies() -> Column:
    u = F.pmod(F.col("_row"), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(F.when(F.col("_stats_words") > 0, F.col("_rate")).otherwise(1.0) + u).cast("int")


class Mixer:
    """Fits the posterior and the rates on ``docs``; then rates any of its rows."""

    def __init__(self, docs: DataFrame, labelled: DataFrame, targets: dict[str, float], reduce: tuple[str, ...] = (), budget: float | None = None):
        self.domains = list(targets)
        self.posterior = Posterior(sample_of(docs, labelled), self.domains)
        self.narrow = written(self._told(docs.select("doc_id", "text"), False).drop("_stats"), "mixing-posteriors")
        self.steps, self.reached, self.targets = descend(
            self.narrow, [targets[d] for d in self.domains], [self.domains.index(d) for d in reduce], budget)
        #: Relative miss of each domain whose target isn't reached.
        self.missed = missed(self.domains, self.reached, self.targets)

    def _told(self, docs: DataFrame, keep_text: bool) -> DataFrame:
        row = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
        return self.posterior.add(text_stats.with_statistics(row, keep_text=keep_text))

    def rates(self) -> DataFrame:
        """(doc_id, domain, tokens, rate, copies) per row."""
        p = F.col("_p")
        best = F.array(*[F.lit(d) for d in self.domains])[F.array_position(p, F.array_max(p)).cast("int") - 1]
        return self.narrow.withColumn("_rate", _rate(self.steps)).select("doc_id", best.alias("domain"), F.col("_stats_words").alias("tokens"),
                                                                         F.round("_rate", 6).alias("rate"), _copies().alias("copies"))

    def mixed(self, docs: DataFrame) -> DataFrame:
        """``docs`` with every row as often as its rate says."""
        rows = set_aside(docs, ("doc_id", "text"))
        rated = self._told(rows, True).drop("_stats").withColumn("_rate", _rate(self.steps))
        return (rated.withColumn("_copies", _copies()).filter("_copies > 0")
                .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
                .select(*rows.columns).toDF(*docs.columns))


#: The registered mix: documents of low quality are thinned out, the rest is weighted by language.
TARGETS = {"en": 0.50, "fr": 0.17, "de": 0.17, "es": 0.12, "low": 0.04}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: ``low`` for quality 0, else the language."""
    known = labels.filter("quality is not null").select(F.col("doc_id").alias("_id"), "quality")
    return docs.select("doc_id", "lang").join(known, F.col("doc_id") == F.col("_id")).select(
        "doc_id", F.when(F.col("quality") == 0, F.lit("low")).otherwise(F.col("lang")).alias("domain"))


def mixer(docs: DataFrame, labels: DataFrame) -> Mixer:
    return Mixer(docs, labelled_domains(docs, labels), TARGETS, reduce=("low",))
