"""Line dedup against brute force over all earlier documents."""
import hashlib
import random

import pytest

from llm import line_dedup


@pytest.fixture(scope="module")
def llm(spark):
    from llm.tables import ship
    ship(spark)
    return spark


def _length(x):
    return len(x.strip(" \t\r"))


def _brute(known, accepts):
    """Every document aligned with every earlier one: (doc_id, lines, deleted, sha256 of the rest)."""
    out = []
    for d, t in known:
        a, gone = t.split("\n"), set()
        for e, u in known:
            if e < d:
                for i, _, n in line_dedup.patience(a, u.split("\n")):
                    if accepts([_length(x) for x in a[i:i + n]]):
                        gone |= set(range(i, i + n))
        out.append((d, len(a), len(gone), hashlib.sha256("\n".join(x for i, x in enumerate(a) if i not in gone).encode()).hexdigest()))
    return sorted(out)


def _got(llm, known):
    return sorted(tuple(r) for r in line_dedup.dedup_lines(llm.createDataFrame(known, "doc_id long, text string")).collect())


X, Y, Z = (c * line_dedup.MIN_CHARS for c in "xyz")


def _long(lengths):
    return max(lengths) >= line_dedup.MIN_CHARS


def test_lines_are_aligned_with_later_holders_too(llm):
    crossed = [(1, f"{X}\n{Y}"), (2, f"{Y}\n{X}"), (3, f"{Y}\n{X}")]
    got = _got(llm, crossed)
    assert got == _brute(crossed, _long) and got[2][2] == 2
    # The line is twice in a gap of its first holder.
    twice = [(1, f"{X}\nb\n{X}"), (2, f"c\n{X}\nd")]
    assert _got(llm, twice) == _brute(twice, _long) and _got(llm, twice)[1][2] == 1


def test_rounds_equal_brute_force(llm):
    rng = random.Random(3)
    pool = [f"line number {k} of the pool of lines" for k in range(7)]
    known = [(k, "\n".join([f"{k} is the start", *rng.choices(pool, k=rng.randrange(1, 7))])) for k in range(60)]
    known += [(100 + k, "\n".join([Z] * (k + 1))) for k in range(9)]
    got = _got(llm, known)
    assert got == _brute(known, _long)


def test_lcs():
    rng = random.Random(4)
    def length(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]
    bound = line_dedup.TABLE_BITS
    try:
        for bits in (bound, 12):
            line_dedup.TABLE_BITS = bits
            for _ in range(300):
                a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
                found = line_dedup._lcs(a, b)
                assert all(a[i] == b[j] for i, j in found) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
                assert len(found) == length(a, b)
    finally:
        line_dedup.TABLE_BITS = bound
    assert line_dedup.patience(list("aXbXc"), list("dXeXf")) == [(1, 1, 1), (3, 3, 1)]


def test_short_lines_count_together(llm):
    verse = [f"verse {k} x" for k in range(8)]
    known = [(1, "\n".join(verse)), (2, "\n".join(["a b", *verse, "c d"])), (3, "\n".join(["e", *verse[:2], "f", *verse[4:7]])),
             (4, "\n".join([verse[0], "", "", verse[1], verse[2]]))]
    got = _got(llm, known)
    assert got == _brute(known, lambda lengths: sum(lengths) >= line_dedup.MIN_CHARS)
    assert got[1][2] == 8 and got[2][2] == 3
