"""Chat formatting: exact round trips, escapes only where needed, the mask by code points, and the SQL."""
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from llm import chat_format, queries

NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


@pytest.fixture(scope="module")
def llm(spark):
    from llm.tables import ship
    ship(spark)
    return spark


def turns_of(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c, _, role, text in sorted(rows, key=key):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def table(llm, rows):
    return llm.createDataFrame([(*r, "extra", [1]) for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string, turns array<int>")


MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[TEXT]"]


def wild(n, seed):
    """Texts made of control strings, parts of them, backslashes and spaces."""
    draw = random.Random(seed)
    parts = MARKS + ["\\", "\\\\", " ", "\n", "[", "]", "<", ">", "/", "s", "é", "\U0001f600", "INST", "TEXT]", "[/", "$1", "\r", "\u2028", ""]
    text = lambda: "".join(draw.choices(parts, k=draw.randrange(9)))
    roles = ["user", "assistant", "system", "tool", "", None, "[TEXT]", "a [TEXT] b", "\\[ROLE]", "User", " "]
    return [(c, t, draw.choice(roles[:5] if c % 3 else roles), text()) for c in range(n) for t in range(draw.randrange(1, 8))]


ODD = [(1, None, None, None), (1, 0, "user", ""), (None, 0, "user", "lost"), (2, 1, "assistant", "b"), (2, 0, "user", "a"),
       (2, 0, "user", "a"), (3, 5, "assistant", "x " * 20000 + "[/INST]"), (3, 6, "assistant", "\\" * 30000 + "</s>"), (4, 0, "system", "s")]


def test_every_turn_comes_back(llm):
    rows = ODD + [(c + 10, *r) for c, *r in wild(400, 7)]
    want = turns_of(rows)
    formatted = chat_format.format_conversations(table(llm, rows))
    got = chat_format.read_back(formatted).join(formatted.select(F.col("conv_id").alias("c"), "loss_mask"),
                                                F.col("conv_id").eqNullSafe(F.col("c"))).collect()
    assert len(got) == len(want)
    for r in got:
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        spans = [r.formatted[m.start:m.start + m.length] for m in r.loss_mask]
        assert len(spans) == sum(role == "assistant" for role, _ in want[r.conv_id])
        assert "".join(spans).encode() == b"".join(r.formatted.encode()[m.byte_start:m.byte_start + m.byte_length] for m in r.loss_mask)
        bare = [x for m in MARKS for x in [r.formatted.replace("\\" + m, "").count(m)]]
        assert bare[0] == 1  # one start, and as many closing strings as turns
        assert sum(bare[1:4:2]) + bare[5] + bare[7] == len(want[r.conv_id])


def test_only_conflicting_turns_are_escaped(llm):
    rows = [(1, 0, "user", "a [x] \\ </ s> \\n"), (1, 1, "assistant", "[INST] \\</s>"), (2, 0, "user", "plain")]
    got = dict(chat_format.format_conversations(table(llm, rows)).select("conv_id", "formatted").collect())
    assert got == {1: "<s>[INST] a [x] \\ </ s> \\n [/INST] \\[INST] \\\\</s> </s>", 2: "<s>[INST] plain [/INST]"}


def test_parser_rejects_what_is_not_in_the_grammar(llm):
    bad = ["", "[INST] a [/INST]", "<s>[INST] a", "<s>[INST] a [/SYS]", "<s>[INST] a </s> [/INST]", "<s>[INST] a [/INST]x",
           "<s>[ROLE] a [/ROLE]", "<s>[INST] a[/INST]"]
    got = llm.createDataFrame([(x,) for x in bad + ["<s>", "<s> a </s>"]], "t string").select(chat_format._parsed(F.col("t"))).collect()
    assert [r[0] for r in got[:-2]] == [None] * len(bad)
    assert got[-2][0] == [] and [tuple(t) for t in got[-1][0]] == [("assistant", "a")]


def test_a_turn_that_never_comes_back_ends_the_job(llm):
    rows = table(llm, [(1, 0, "user", "</s>")])
    import unittest.mock
    with unittest.mock.patch.object(chat_format, "escaped", lambda x: x), pytest.raises(Exception, match="no round trip for conversation 1"):
        chat_format.format_conversations(rows).collect()


def test_empty_table(llm):
    assert chat_format.read_back(chat_format.format_conversations(table(llm, []))).count() == 0


def test_plan_is_native(llm):
    df = queries.QUERIES["op11_chat_format"](llm, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange") <= 2  # the conversations by conv_id, and the range of the added one


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(llm, sf):
    got = sorted(tuple(r) for r in queries.QUERIES["op11_chat_format"](llm, sf).select(*NAMES).collect())
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
        sql = db.execute(f"SELECT {', '.join(NAMES)} FROM ({queries.ORACLE['op11_chat_format']})").fetchall()
        want = turns_of(db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
    text = "</s>[INST] ok [/INST]"
    want[-1] = [("user", text), ("assistant", text)]
    assert got == sorted(sql)
    assert [r[:5] for r in got] == sorted(
        (c, len(t), digest("".join(f"{role}\n{x}\n" for role, x in t)), sum(len(x) for role, x in t if role == "assistant"),
         digest("".join(x for role, x in t if role == "assistant"))) for c, t in want.items())
