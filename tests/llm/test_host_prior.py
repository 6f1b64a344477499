"""Host rates and verdicts against a plain computation, on hosts of very unlike sizes."""
import math
import random

import pytest

from llm import host_rules

GOOD = " ".join(f"word{i}" for i in range(30))
BAD = "too short"


def _brute(judged):
    """{source: (rate of each rule, rejected)} from the documents' figures."""
    hosts = {}
    for r in judged:
        w = max(r.n_words, 1)
        fails = [r.base_failed, 10 * r.n_symbols > r.word_chars, 20 * r.n_dup_lines > w, r.word_chars > 12 * w or r.word_chars < 2 * w]
        hosts.setdefault(r.source, []).append(fails)
    total, out = len(judged), {h: ([], []) for h in hosts}
    for k in range(4):
        m = sum(f[k] for docs in hosts.values() for f in docs) / total
        spread = sum(len(d) * (sum(f[k] for f in d) / len(d) - m) ** 2 for d in hosts.values())
        free = len(hosts) - 1
        between = total - sum(len(d) ** 2 for d in hosts.values()) / total - free
        size = 1e6
        if between > 1e-9 and 0 < m < 1:
            c = (spread / (m * (1 - m)) - free) / between
            if c > 0:
                size = min(max(1 / c - 1, 1.0), 1e6)
        for h, d in hosts.items():
            p = (sum(f[k] for f in d) + m * size) / (len(d) + size)
            out[h][0].append(p)
            out[h][1].append(p - 1.645 * math.sqrt(max(p * (1 - p), 0) / (len(d) + size + 1)) > 0.6)
    return {h: (rates, any(sure)) for h, (rates, sure) in out.items()}


def _judge(spark, rows):
    docs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")
    judged = host_rules.judge(docs).collect()
    want = _brute(judged)
    for r in judged:
        rates, rejected = want[r.source]
        assert [r.host_r_base, r.host_r_symbols, r.host_r_lines, r.host_r_word_length] == pytest.approx(rates, abs=2e-6)
        assert r.kept == (not r.base_failed and not rejected)
    return {r.source for r in judged if want[r.source][1]}


def test_hosts_of_all_sizes(spark):
    rnd = random.Random(3)
    rows = [(f"h{h}", BAD if rnd.random() < share else rnd.choice([GOOD] * 8 + [GOOD + " ## $$ %% ||" * 9, "a\na\n" * 9 + GOOD]))
            for h, (n, share) in enumerate([(1, 1), (1, 0), (2, .5), (40, .1), (200, .05), (30, .95), (7, 1), (60, .6)]) for _ in range(n)]
    rejected = _judge(spark, rows + [(None, GOOD), (None, BAD)])
    assert "h5" in rejected and not rejected & {"h0", "h1", "h2", "h3", "h4", None}


def test_one_document_hosts_are_no_evidence(spark):
    # Nearly half of the documents fail, each from a host of its own.
    assert _judge(spark, [(f"h{i}", BAD if i % 5 < 2 else GOOD) for i in range(60)]) == set()


def test_lone_host_and_hosts_that_agree(spark):
    assert _judge(spark, [("a", GOOD), ("a", BAD)]) == set()
    assert _judge(spark, [(h, t) for h in "abcd" for t in (GOOD, GOOD, BAD)]) == set()
    assert _judge(spark, [("a", GOOD)] * 3) == set()
