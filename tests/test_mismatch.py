"""The first mismatch by block prints equals a row by row compare."""
import random

import pytest

from topicspark.operators import audit

SCHEMA = "g string, k double, question string"


def _expected(a, b):
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    strip = lambda v: v if v is None else v.strip()
    for i, (x, y) in enumerate(zip(order(a), order(b))):
        if strip(x[2]) != strip(y[2]):
            return [(i, x[2], y[2])]
    return []


@pytest.mark.parametrize("block,change", [(1, 0), (4, 17), (4, 39), (7, None), (1000, 25), (4, 40)])
def test_first_mismatch(spark, monkeypatch, block, change):
    monkeypatch.setattr(audit, "COMPARE_BLOCK", block)
    rnd = random.Random(block)
    a = [(rnd.choice([None, "x", "y", "z"]), i + 0.5, rnd.choice([None, "", f" text {i}\n", "same"])) for i in range(40)]
    # The same in other space, some rows more, and one value changed (also two swapped ones).
    b = [(g, k, None if v is None else f"\t{v} ") for g, k, v in a] + [("zz", 100.0 + i, f"more {i}") for i in range(5)]
    if change is not None and change < 40:
        at = sorted(range(40), key=lambda i: (a[i][0] is not None, a[i][0] or "", a[i][1]))[change]
        b[at] = (*b[at][:2], "changed")
    rnd.shuffle(b)
    got = audit.first_mismatch(spark.createDataFrame(a, SCHEMA), ["k"], spark.createDataFrame(b, SCHEMA), ["k"], a_outer=["g"], b_outer=["g"])
    assert [tuple(r) for r in got.collect()] == _expected(a, b)
    assert got.columns == ["index", "left_value", "right_value"]


def test_swapped_rows_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(audit, "COMPARE_BLOCK", 8)
    a = spark.createDataFrame([("g", float(i), f"t{i}") for i in range(20)], SCHEMA)
    b = spark.createDataFrame([("g", float(i), f"t{ {10: 11, 11: 10}.get(i, i) }") for i in range(20)], SCHEMA)
    assert [tuple(r) for r in audit.first_mismatch(a, ["k"], b, ["k"]).collect()] == [(10, "t10", "t11")]
    assert audit.first_mismatch(a, ["k"], b.limit(0), ["k"]).collect() == []
    assert audit.first_mismatch(a.limit(0), ["k"], b.limit(0), ["k"]).collect() == []


def test_no_row_print_leaves_the_first_block(spark, monkeypatch):
    """The texts of both sides are only read for prints and by literal keys."""
    monkeypatch.setattr(audit, "COMPARE_BLOCK", 4)
    a = spark.createDataFrame([("g", float(i), f"t{i}") for i in range(20)], SCHEMA)
    b = spark.createDataFrame([("g", float(i), f"t{max(i, 9)}") for i in range(20)], SCHEMA)
    got = audit.first_mismatch(a, ["k"], b, ["k"])
    assert [tuple(r) for r in got.collect()] == [(0, "t0", "t9")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<=> 0.0") + plan.count("= 0.0") >= 2 and "Window" not in plan and "Generate" not in plan
