import math
import re
from collections import Counter

import numpy as np

from conftest import SF_SMALL
from topicspark.operators.summarize import summarize
from topicspark.sources import fixtures as fx

TOK = re.compile(r"(?u)\b\w\w+\b")


def sentences(text):
    parts = re.sub(r"([.!?])\s+", "\\1\n", text).split("\n")
    return [p.strip(" ") for p in parts if p.strip(" ")]


def matrix(sents):
    toks = [Counter(TOK.findall(s.lower())) for s in sents]
    vocab = sorted(set().union(*toks)) if toks else []
    n = len(sents)
    df = {t: sum(t in x for x in toks) for t in vocab}
    m = np.zeros((n, len(vocab)))
    for i, x in enumerate(toks):
        for j, t in enumerate(vocab):
            m[i, j] = x[t] * (math.log((1 + n) / (1 + df[t])) + 1)
        nr = np.linalg.norm(m[i])
        if nr > 0:
            m[i] /= nr
    return m


def brute(text, method, top=3):
    s = sentences(text)
    if not s:
        return ""
    m = matrix(s)
    sim = m @ m.T
    deg = sim.sum(axis=1)
    if method == "degree":
        score = deg
    else:
        n = len(s)
        r = np.full(n, 1.0 / n)
        for _ in range(10):
            x = np.where(deg > 0, r / np.where(deg > 0, deg, 1), 0.0)
            r = 0.15 / n + 0.85 * (sim @ x)
        score = r
    order = sorted(range(len(s)), key=lambda i: (-round(score[i], 9), i))[:top]
    return " ".join(s[i] for i in sorted(order))


def test_degree_and_textrank_match_explicit_matrix(spark):
    art = fx.articles(spark, SF_SMALL).orderBy("topic", "id").limit(12).cache()
    rows = {(r.topic, r.id): "\n" + r.answer for r in art.collect()}
    for method in ("degree", "textrank"):
        got = {(r.topic, r.id): r.summary for r in summarize(art, ["topic", "id"], method=method).collect()}
        assert set(got) == set(rows)
        for k, text in rows.items():
            assert got[k] == brute(text, method), (method, k)


def test_empty_and_short_rows(spark):
    df = spark.createDataFrame(
        [("t", 1, "", ""), ("t", 2, None, "One. Two."), ("t", 3, "Q?", "A. B. C. D.")],
        "topic string, id long, question string, answer string")
    got = {r.id: r.summary for r in summarize(df, ["topic", "id"]).collect()}
    assert got[1] == ""
    assert got[2] == "One. Two."
    assert len(got[3].split(" ")) == 3
