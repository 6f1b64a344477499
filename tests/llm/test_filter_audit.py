"""The filter audit against a brute force over documents, orders and steps, and its SQL against both."""
import itertools
import re

import duckdb
import pytest

from llm import filter_audit, queries

LETTERS = "ABCDE"


@pytest.fixture(scope="module")
def llm(spark):
    from llm.tables import ship
    ship(spark)
    return spark


def fails(rows):
    """The failed filters of each (doc_id, text) row."""
    out = []
    for d, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        out.append(f + "E" * any(d is not None and e is not None and e < d and (u or "") == t for e, u in rows))
    return out


def brute(rows, good, toxic):
    """rows: (doc_id, text, lang)."""
    marks = fails([r[:2] for r in rows])
    out = []
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, marks, strict=True) if (r[2] or "") == part]
        part_rows, shapley = [], dict.fromkeys(LETTERS, 0)
        for order in map("".join, itertools.permutations(LETTERS)):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[1]]
                left = [m for m in left if x not in m[1]]
                redundant = sum(x in f and any(y in f for y in order[:step - 1]) for _, f in mine)
                shapley[x] += len(gone)
                part_rows.append([part, order, step, len(left), len(gone), redundant, sum(f == x for _, f in mine),
                                  sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), x])
        out += [(*r[:-1], shapley[r[-1]]) for r in part_rows]
    return sorted(out)


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_of_odd_rows(llm):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(1, long, "en"), (2, long, "de"), (2, long, "de"), (3, "", "en"), (4, None, None), (5, "   \n", ""), (6, "A " * 250, "en"),
            (None, long, "en"), (7, long + " #", "fr"), (8, "x|y", "en"), (9, "x|y", "en"), (8, "x|y", "en"),
            (10, "é" * 50 + " ABC", "fr"), (11, long.upper(), "en"), (12, "a\x1fb c " * 90 + "a\x0bd " * 30, "en")]
    labels = [(1, 1, 0), (2, 1, 1), (6, 0, 1), (8, 1, 0), (8, 0, 0), (10, None, 1), (None, 1, 1), (99, 1, 1)]
    docs = llm.createDataFrame([(*r, "extra", 7) for r in rows], "doc_id long, text string, lang string, mask string, key int")
    marks = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good, toxic = {d for d, q, _ in labels if q == 1 and d}, {d for d, _, t in labels if t == 1 and d}
    got = sorted(tuple(r) for r in filter_audit.audit(docs, marks).select(*NAMES).collect())
    assert got == brute(rows, good, toxic)
    assert len(got) == 600 * 4


def test_many_parts_are_handed_on(llm, monkeypatch):
    docs = llm.range(1500).selectExpr("id AS doc_id", "'x' AS text", "concat('l', id % 1200) AS lang")
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels).filter("filter_order = 'EABCD' AND step = 1").collect()
    assert len(got) == 1200
    assert sum(r.removed for r in got) == 1499 and sum(r.kept for r in got) == 1


def test_empty_tables(llm):
    docs = llm.createDataFrame([], "doc_id long, text string, lang string")
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0


def test_fields_do_not_run_over():
    big = filter_audit.outcomes(0b11111 | filter_audit.GOOD)
    fields = (big * (2**63 - 1)).to_bytes(filter_audit.FIELD * filter_audit.FIELDS, "little")
    got = {int.from_bytes(fields[i:i + 8], "little") for i in range(0, len(fields), 8)}
    assert got == {0, 2**63 - 1}


def test_query_equals_sql_and_brute_force(llm):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.QUERIES["op13_filter_audit"](llm, sf).select(*NAMES).collect())
    with duckdb.connect() as db:
        for t in ("documents", "labels"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        rows = db.execute("SELECT doc_id, text, lang FROM documents").fetchall()
        marks = db.execute("SELECT * FROM labels").fetchall()
        sql = db.execute(f"SELECT {', '.join(NAMES)} FROM ({queries.ORACLE['op13_filter_audit']})").fetchall()
    assert got == sorted(sql)
    assert got == brute(rows, {m[0] for m in marks if m[1] == 1}, {m[0] for m in marks if m[2] == 1})
