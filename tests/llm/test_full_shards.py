"""Balanced shards where copies fill the table."""
from collections import defaultdict

import pytest

from llm import balanced_shards


@pytest.fixture(scope="module")
def llm(spark):
    from llm.tables import ship
    ship(spark)
    return spark


def test_full_shards_exchange_equal_volumes():
    # Both are full; what wants from 0 to 1 also leaves 1, save 2 rows.
    share = balanced_shards.shares_of({0: 100, 1: 100}, {(0, 1): 10, (1, 0): 8}, 100)
    assert share[0] == 1 and abs(share[1] - 0.8) < 1e-3
    assert balanced_shards.shares_of({0: 100, 1: 100}, {(0, 1): 10}, 100) == {1: 0}


def test_every_text_has_a_copy(llm):
    table = llm.createDataFrame([(i, f"text {i // 2}") for i in range(2400)], "doc_id long, text string")
    shards = defaultdict(list)
    pairs = defaultdict(set)
    for r in balanced_shards.shard_documents(table, 4).collect():
        shards[r.shard].append(r.slot)
        pairs[r.doc_id // 2].add(r.shard)
    assert all(sorted(s) == list(range(600)) for s in shards.values()) and len(shards) == 4
    assert sum(len(s) > 1 for s in pairs.values()) < 60  # of 1200; 900 at the start
