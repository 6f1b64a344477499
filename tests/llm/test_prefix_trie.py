"""The prefix trie against a brute force over whole sequences, and its SQL against both."""
import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from llm import prefix_trie, queries

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def llm(spark):
    from llm.tables import ship
    ship(spark)
    return spark


def brute(rows):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own[c].append((role or "", text or ""))
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), str(min(members[p[:-1]])) if p else "None", len(m), children.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest())
                  for p, m in members.items())


def rows_of(df):
    return sorted((r[0], r[1], str(r[2]), *r[3:]) for r in df.select(*NAMES).collect())


def table(llm, rows):
    return llm.createDataFrame([(*r, b"x", 3) for r in rows],
                               "conv_id long, turn long, role string, text string, id binary, own int")


#: Null turns, roles, texts and ids, turn numbers with gaps, an absent base, a base shorter than h, rows out of order.
ODD = ([(c, t, "user" if t % 2 else "assistant", f"text {t} {'é' * (c % 3)}") for c in range(100, 140) for t in range(c % 9)]
       + [(250, None, None, None), (250, 7, "user", "x"), (250, -3, "user", "y"), (None, 0, "user", "lost"), (57, 0, "user", "")]
       + [(301, t, "a", "b") for t in range(30)] + [(300, t, "a", "b") for t in range(25)] + [(302, 0, "user,", "x"), (303, 0, "user", ",x")])


@pytest.mark.parametrize("block", [prefix_trie.BLOCK, 4])
def test_trie_of_odd_rows(llm, block, monkeypatch):
    if block != prefix_trie.BLOCK:
        import pyarrow as pa
        monkeypatch.setattr(prefix_trie, "BLOCK", block)
        monkeypatch.setattr(prefix_trie, "TURNS", prefix_trie.TURNS[:block])
        monkeypatch.setattr(prefix_trie, "_BLOCKS", pa.schema(list(prefix_trie._BLOCKS)[:5 + block]))
        monkeypatch.setattr(prefix_trie, "BLOCKS", ", ".join(prefix_trie.BLOCKS.split(", t")[0:1] + [
            f"t{i} struct<id: binary, chars: bigint>" for i in range(block)]))
        # Workers import the module anew; the cut is made here instead.
        monkeypatch.setattr(prefix_trie, "blocks", lambda sequences: _cut_here(llm, sequences))
    assert rows_of(prefix_trie.prefix_trie(table(llm, ODD))) == brute(ODD)


def _cut_here(llm, sequences):
    import pyarrow as pa
    rows = sequences.orderBy("conv_id", "own", "turn", "id").select("conv_id", "own", "skip", "id", "chars").toArrow()
    out = pa.Table.from_batches(list(prefix_trie._cut(rows.to_batches())), schema=prefix_trie._BLOCKS)
    return llm.createDataFrame(out.to_pylist(), prefix_trie.BLOCKS)


def test_long_conversations_pass_many_blocks(llm):
    rows = [(c, t, "user", f"{min(t, c * 40)}") for c in range(1, 6) for t in range(c * 37)]
    assert rows_of(prefix_trie.prefix_trie(table(llm, rows))) == brute(rows)


def test_copies_end_at_one_node_in_several_runs(llm, monkeypatch):
    rows = [(c, t, "user", "same") for c in range(0, 90_000, 100) for t in range(3)]
    import pyarrow as pa
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    batch = pa.RecordBatch.from_pydict({"id": [b"a"] * 900 + [b"b"], "conv_id": [r[0] for r in rows[::3]] + [5]})
    runs = list(prefix_trie._joined([batch.slice(0, 13), batch.slice(13)]))
    assert max(len(x.split(",")) for b in runs for x in b.column("ids").to_pylist()) == 7
    done = [r for b in prefix_trie._hashed(runs) for r in b.to_pylist()]
    assert done == [{"id": b"a", "ends_sha256": hashlib.sha256(",".join(str(r[0]) for r in rows[::3]).encode()).hexdigest()},
                    {"id": b"b", "ends_sha256": hashlib.sha256(b"5").hexdigest()}]
    assert rows_of(prefix_trie.prefix_trie(table(llm, rows))) == brute(rows)


def test_empty_table(llm):
    assert prefix_trie.prefix_trie(table(llm, [])).count() == 0


def test_query_equals_sql_and_brute_force(llm):
    sf = "/root/testdata/sf0.01"
    got = rows_of(queries.QUERIES["op12_prefix_trie"](llm, sf))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
        rows = db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
        sql = db.execute(f"SELECT {', '.join(NAMES)} FROM ({queries.ORACLE['op12_prefix_trie']})").fetchall()
    assert got == brute(rows)
    assert got == sorted((r[0], r[1], str(r[2]), *r[3:]) for r in sql)
