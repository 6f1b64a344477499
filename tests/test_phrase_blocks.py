"""Rows are counted in blocks, and what is written and shuffled stays about the size of the texts."""
import math
import os
import random
import re
import time
from collections import Counter

import pytest

from topicspark.operators import keywords

TOK = re.compile(r"(?u)\b\w\w+\b")
SCHEMA = "topic string, id long, answer string"


def expected(rows, top):
    grams = []
    for _, _, text in rows:
        t = TOK.findall((text or "").lower())
        grams.append(Counter(t + [f"{a} {b}" for a, b in zip(t, t[1:])]))
    df, n, per = Counter(p for g in grams for p in g), len(rows), {}
    for (topic, i, _), g in zip(rows, grams):
        per.setdefault((topic, i), []).extend((c * (math.log((1 + n) / (1 + df[p])) + 1), p) for p, c in g.items())
    ranked = {k: sorted(v, key=lambda x: (-round(x[0], 9), x[1].encode()))[:top] for k, v in per.items()}
    return sorted((str(k), r, p, round(s, 6)) for k, v in ranked.items() for r, (s, p) in enumerate(v, 1))


def got(spark, rows, top):
    out = keywords.keyphrases(spark.createDataFrame(rows, SCHEMA), ["topic", "id"], "answer", top)
    assert out.columns == ["topic", "id", "rank", "phrase", "score"]
    return sorted((str((r.topic, r.id)), r["rank"], r.phrase, round(r.score, 6)) for r in out.collect())


def texts(n, words, seed=5):
    rnd = random.Random(seed)
    kinds = ["hot", "hota", "été", "naïve", "東京", "x_1", "42", "9a"] + [f"w{rnd.randrange(10 ** rnd.randint(1, 6))}" for _ in range(words)]
    return [" ".join(rnd.choice(kinds[:8] if rnd.random() < 0.3 else kinds) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("block,bucket", [(1, 40), (70, 300), (10 ** 6, 2 * 10 ** 6)])
def test_blocks_of_any_size_give_all_phrases(spark, monkeypatch, block, bucket):
    rows = [("a" if i % 3 else None, i, x) for i, x in enumerate(texts(60, 80))]
    rows += [("a", 1000, None), ("a", 1001, ""), ("b", None, "hot hot 東京 hot"), ("a", 1002, "lone"), ("b", 7, "Hot HOT été! a b c"),
             ("c", 1, "x " * 50), ("d", 1, " ".join(f"v{i:03d}" for i in range(300)))]
    rows += [("b", 7, "zz hot zz")]  # a key that comes twice: both rows' phrases are ranked together
    monkeypatch.setattr(keywords, "BLOCK_TOKENS", block)
    monkeypatch.setattr(keywords, "BUCKET_TOKENS", bucket)
    assert got(spark, rows, 4) == expected(rows, 4)


def test_no_rows_and_no_words(spark):
    assert got(spark, [], 3) == []
    assert got(spark, [("a", 1, None), ("a", 2, "- - x"), (None, None, "")], 3) == []


def shuffle_files(spark):
    found = {}
    for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for at, _, names in os.walk(d.getPath()):
            found.update({x: os.path.getsize(os.path.join(at, x)) for x in names if x.startswith("shuffle_") and x.endswith(".data")})
    return found


def test_what_is_written_is_less_than_the_texts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(keywords, "scratch_path", lambda s, name: str(tmp_path / name))
    rows = [("a", i, " ".join(texts(8, 3000, seed=i % 7 * 1000 + i))) for i in range(400)]
    size = sum(len(x.encode()) for _, _, x in rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    before = shuffle_files(spark)
    out = keywords.keyphrases(docs, ["topic", "id"], "answer")
    for _ in range(50):  # files are removed a moment after the query
        left = sum(v for k, v in shuffle_files(spark).items() if k not in before)
        if left < size / 20:
            break
        time.sleep(0.2)
    written = sum(os.path.getsize(os.path.join(at, x)) for at, _, names in os.walk(tmp_path) for x in names)
    assert left < size / 20
    assert written < size
    assert out.count() == 2000
    assert spark.conf.get(keywords.FREE_SHUFFLES) == "false"
