"""Quality classifier: a sparse ensemble of rules.

Text statistics of a bounded sample of the labelled documents train a random
forest of shallow trees (Spark ML). Every path from a root to a node is a
rule, a conjunction of threshold tests; a logistic regression with an L1
penalty over all distinct rules keeps the few that matter. The rules with a
weight are compiled to Spark column expressions over the statistics, and the
score is the logistic function of their weighted sum.

Labels come only from rows whose crc32 of the id's text leaves a remainder
other than 0 by ``FOLDS``; of these at most ``MAX_TRAIN`` (those with the
smallest hash) are fitted. Label, language, source and id are never inputs.

Defined cases: null or empty text has statistics of zero and gets a score
like any other; without labels, or with one class only, every score is the
mean label (0.5 without any). Repeated rows are scored each for themselves;
repeated label rows count as often as they are there; labels that are null or
have no document teach nothing. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import text_stats
from llm.tables import written

FOLDS = 5
#: Bound of the training sample, in labelled rows.
MAX_TRAIN = 12_000
TREES, DEPTH, PENALTY = 24, 3, 0.002
THRESHOLD = 0.3
INPUTS = [k for k in text_stats.QUALITY]

Rule = tuple[tuple[int, str, float], ...]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def rules_of(tree_text: str) -> list[Rule]:
    """The conjunctions on the paths of a tree, from Spark ML's printed form."""
    out, path = [], []
    for line in tree_text.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(m[3]), m[4], float(m[5])))]
            out.append(tuple(t for _, t in path))
    return out


def _tightest(rule: Rule) -> Rule:
    """Each statistic and direction once, by its tightest threshold."""
    best: dict[tuple[int, str], float] = {}
    for i, op, x in rule:
        best[i, op] = min(best.get((i, op), x), x) if op == "<=" else max(best.get((i, op), x), x)
    return tuple(sorted((i, op, x) for (i, op), x in best.items()))


def distinct_rules(trees: list[str]) -> list[Rule]:
    """Every rule of the printed trees once, at most 2^(DEPTH + 1) - 2 a tree."""
    return list(dict.fromkeys(_tightest(r) for tree in trees for r in rules_of(tree)))


def rule_column(rule: Rule, stats: Column) -> Column:
    out = F.lit(True)
    for i, op, x in rule:
        out = out & ((stats[i] <= x) if op == "<=" else (stats[i] > x))
    return out.cast("double")


def fit(train: DataFrame) -> tuple[float, list[tuple[float, Rule]]]:
    """(intercept, weighted rules) from ``train(x array<double>, label double)``."""
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        mean = min(max(next(iter(counts), 0.5), 1e-6), 1 - 1e-6)
        return math.log(mean / (1 - mean)), []
    vectors = train.select(array_to_vector("x").alias("features"), "x", "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt",
                                    minInstancesPerNode=max(2, total // 500)).fit(vectors)
    rules = distinct_rules([tree.toDebugString for tree in forest.trees])
    matrix = train.select(array_to_vector(F.array(*[rule_column(r, F.col("x")) for r in rules])).alias("features"), "label")
    model = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=True).fit(matrix)
    weights = model.coefficients.toArray()
    return float(model.intercept), [(float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-9]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, label) of the bounded sample of labelled documents outside the held-out part, written."""
    usable = labels.filter("doc_id is not null and quality is not null").select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("label")).filter(~held_out(F.col("_id")))
    chosen = usable.orderBy(F.xxhash64("_id"), "_id", "label").limit(MAX_TRAIN)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    rows = text_stats.with_statistics(joined)
    narrow = rows.select("doc_id", F.slice("_stats", 1, len(INPUTS)).alias("x"), "label")
    # One order whatever the tasks, as the forest draws its samples by position: the sample is bounded.
    return written(narrow.repartitionByRange(1, "doc_id", "label").sortWithinPartitions("doc_id", "label", "x"), "rule-training")


def score_column(model: tuple[float, list[tuple[float, Rule]]], stats: Column) -> Column:
    total = F.lit(model[0])
    for w, r in model[1]:
        total = total + F.lit(w) * rule_column(r, stats)
    return 1 / (1 + F.exp(-total))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    model = fit(training_rows(docs, labels))
    stats = text_stats.with_statistics(docs.select("doc_id", "text"))
    scored = stats.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                          score_column(model, F.col("_stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
