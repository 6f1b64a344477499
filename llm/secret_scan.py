"""Secret scan by a battery of randomness tests.

Base spans come from three fixed patterns. The method adds spans: maximal
runs of token characters of ``LEAST`` or more. The encoding of a run is
inferred (the smallest known alphabet that holds it; a run that none holds is
split into its longest part that one holds and what lies before and after,
split in turn, and each part of ``LEAST`` or more is a run), and three tests are made on its symbols: chi-squared
uniformity over the alphabet, the runs test about the alphabet's middle, and
the lag-one serial correlation. Their p values are combined by Fisher's
method into one number, high for runs that look random.

What ordinary text reaches on the same battery is measured on the corpus
itself: the letters of every text, cut into strings of each of a few lengths. A run's
p value is the share of ordinary strings of its length class that look at
least as random. Over all runs a weighted Benjamini-Hochberg rule, in which
longer runs, for which the tests see more, weigh more, keeps the share of
false discoveries at ``FDR``. Both distributions are histograms of a fixed
number of bins, added up on the executors.

Offsets are code points, ends exclusive. Runs that touch a base span add
nothing. Defined cases: null text is an empty text without spans; repeated
rows are scanned each for themselves; extra columns are ignored; texts are
scanned whole.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words as W
from llm.tables import written

LEAST, FDR = 20, 0.05
LENGTHS = (20, 24, 28, 32, 40, 48, 64)  # lower ends of the length classes
BINS, PER_DECADE = 64, 4

#: The base patterns, and the words without which the first can't match.
ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "random")

#: The alphabets, smallest first.
ALPHABETS = ["0123456789", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"]
_PLACES = [{c: i for i, c in enumerate(a)} for a in ALPHABETS]
_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"]] = True
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True


def _runs(raw: np.ndarray, off: np.ndarray, inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs of ``inside`` bytes, no shorter than ``least``."""
    member = inside[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1] | edge[1:-1]
    last[:-1] &= ~member[1:] | edge[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = e - s >= least
    return np.searchsorted(off, s[long], "right") - 1, s[long], e[long]


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution (a fixed rational approximation, to 1e-7)."""
    a = np.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    p = np.exp(-a * a / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, p, 1 - p)


def battery(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Combined p value of randomness for each row of symbols (rows x length)."""
    rows, n = symbols.shape
    counts = np.bincount((np.arange(rows)[:, None] * alphabet + symbols).ravel(), minlength=rows * alphabet).reshape(rows, alphabet).astype(np.float64)
    expect = n / alphabet
    chi, df = ((counts - expect) ** 2).sum(axis=1) / expect, alphabet - 1
    uniform = _normal_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = symbols >= alphabet / 2
    n1 = high.sum(axis=1)
    n0 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2 * n1 * n0 / n
    var = np.maximum((mean - 1) * (mean - 2) / max(n - 1, 1), 1e-9)
    order = np.where((n1 == 0) | (n0 == 0), 1e-12, 2 * _normal_tail(np.abs(runs - mean) / np.sqrt(var)))
    x = symbols - symbols.mean(axis=1, keepdims=True)
    power = (x * x).sum(axis=1)
    r = (x[:, 1:] * x[:, :-1]).sum(axis=1) / np.maximum(power, 1e-9)
    serial = np.where(power == 0, 1e-12, 2 * _normal_tail(np.abs(r + 1 / n) * math.sqrt(n)))
    half = -np.log(np.clip(np.stack([uniform, order, serial]), 1e-30, 1)).sum(axis=0)
    return np.exp(-half) * (1 + half + half * half / 2)  # upper tail of chi-squared with 6 degrees


def _bin(p: np.ndarray) -> np.ndarray:
    """0 for the most random, one more for each quarter of a decade less."""
    return np.minimum(BINS - 1, np.floor(-PER_DECADE * np.log10(np.maximum(p, 1e-300)))).astype(np.int64)


def length_class(n: int) -> int:
    return max(i for i, least in enumerate(LENGTHS) if n >= least)


def parts_of(run: str) -> list[tuple[int, int]]:
    """(start, end) of the parts of a run that are scored: all of it, if an alphabet holds it within its edges."""
    core = run.strip("-_/+")
    if not core or any(all(c in place for c in core) for place in _PLACES):
        return [(0, len(run))]
    at = run.index(core)
    out, todo = [], [(at, at + len(core))]
    while todo:
        i, j = todo.pop()
        if j - i < LEAST:
            continue
        # The longest part in any alphabet: the two widest hold all others.
        best = (0, i, i)
        for place in _PLACES[-2:]:
            cuts = [i - 1, *(k for k in range(i, j) if run[k] not in place), j]
            best = max(best, max((b - a - 1, a + 1, b) for a, b in zip(cuts, cuts[1:])))
        if best[0] >= LEAST:
            out.append(best[1:])
            todo += [(i, best[1]), (best[2], j)]
    return sorted(out)


def score_run(run: str) -> tuple[int, int] | None:
    """(length class, bin) of a run that an alphabet holds."""
    core = run.strip("-_/+")
    if len(core) < LEAST:
        return None
    for alphabet, place in zip(ALPHABETS, _PLACES):
        symbols = [place.get(c, -1) for c in core]
        if min(symbols) >= 0:
            return length_class(len(core)), int(_bin(battery(np.array([symbols]), len(alphabet)))[0])
    return None


def _ordinary(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Histogram (length class x bin) of the letters of each text, cut into strings of each length."""
    hist = np.zeros((len(LENGTHS), BINS), np.int64)
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    where = np.flatnonzero((lower >= 97) & (lower <= 122))
    letters = lower[where].astype(np.int64) - 97
    first = np.searchsorted(where, off)  # of each text, among the letters
    many = np.diff(first)
    place = np.arange(len(letters)) - np.repeat(first[:-1], many)
    for k, n in enumerate(LENGTHS):
        rows = letters[place < np.repeat(many // n * n, many)].reshape(-1, n)
        for at in range(0, len(rows), 1 << 15):
            hist[k] += np.bincount(_bin(battery(rows[at:at + (1 << 15)], 26)), minlength=BINS)
    return hist


def base_spans(text: str, hexes: list[tuple[int, int]], maybe_assign: bool) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns; ``hexes``: the hex runs, already found."""
    found = [(s, "hex", e) for s, e in hexes]
    if maybe_assign:
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    return found


_SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, "
           "found array<struct<start:long,kind:int,stop:long,class:int,bin:int>>, ordinary array<long>")


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: every span found with its class and bin, and the ordinary strings' histogram."""
    def run(batches):
        for b in W.slices(batches):
            raw, off = W.text_bytes(b.column(1))
            n = len(off) - 1
            later = np.concatenate([[0], np.cumsum((raw & 0xC0) == 0x80)]).astype(np.int64)
            point = lambda at, row: int(at - off[row] - (later[at] - later[off[row]]))
            hexes: list[list] = [[] for _ in range(n)]
            for row, s, e in zip(*_runs(raw, off, _HEX, 16)) if len(raw) else ():
                hexes[row].append((point(s, row), point(e, row)))
            tokens: list[list] = [[] for _ in range(n)]
            for row, s, e in zip(*_runs(raw, off, _TOKEN, LEAST)) if len(raw) else ():
                tokens[row].append((point(s, row), point(e, row), raw[s:e].tobytes().decode()))
            data, lower = raw.tobytes(), raw.tobytes().lower()
            some = any(k in lower for k in KEYWORDS)
            out, counts = [], [[], [], []]
            for row in range(n):
                i, j = int(off[row]), int(off[row + 1])
                low = lower[i:j] if some else b""
                maybe = some and any(k in low for k in KEYWORDS)
                spans = hexes[row]
                found = [(s, "hex", e) for s, e in spans]
                if maybe or b"AKIA" in data[i:j]:
                    found = base_spans(data[i:j].decode(), spans, maybe)
                for k, kind in enumerate(KINDS[:3]):
                    counts[k].append(sum(f[1] == kind for f in found))
                rows = [{"start": s, "kind": KINDS.index(kind), "stop": e, "class": -1, "bin": -1} for s, kind, e in found]
                for s, e, token in ((s + i, s + j, token[i:j]) for s, _, token in tokens[row] for i, j in parts_of(token)):
                    if not any(s < fe and fs < e for fs, _, fe in found) and (score := score_run(token)):
                        rows.append({"start": s, "kind": 3, "stop": e, "class": score[0], "bin": score[1]})
                out.append(sorted(rows, key=lambda r: (r["start"], r["kind"])))
            hist = [_ordinary(raw, off).ravel().tolist()] + [None] * (n - 1) if n else []
            span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("class", pa.int32()), ("bin", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(out, pa.list_(span)), pa.array(hist, pa.list_(pa.int64()))],
                ["doc_id", "n_assign", "n_access", "n_hex", "found", "ordinary"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def thresholds(scanned: DataFrame) -> list[int]:
    """For each length class the largest bin that the weighted rule lets through (-1: none)."""
    size = len(LENGTHS) * BINS
    control = scanned.filter("ordinary is not null").select(F.posexplode("ordinary").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    runs = (scanned.select(F.explode("found").alias("f")).filter("f.bin >= 0").groupBy("f.class", "f.bin").agg(F.count(F.lit(1)).alias("n")).collect())
    usual = np.zeros(size)
    for r in control:
        usual[r["at"]] = r["n"]
    usual = usual.reshape(len(LENGTHS), BINS)
    seen = np.zeros((len(LENGTHS), BINS))
    for r in runs:
        seen[r["class"], r["bin"]] = r["n"]
    m = seen.sum()
    if not m:
        return [-1] * len(LENGTHS)
    p = (1 + usual.cumsum(axis=1)) / (1 + usual.sum(axis=1, keepdims=True))
    weight = np.sqrt(np.array(LENGTHS, float))[:, None]
    weight = weight * m / (weight * seen.sum(axis=1, keepdims=True)).sum()
    q = np.minimum(p / weight, 1)
    best = max((x for x in np.unique(q[seen > 0]) if x <= FDR * seen[q <= x].sum() / m), default=-1.0)
    return [int(np.count_nonzero(q[k] <= best)) - 1 for k in range(len(LENGTHS))]


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of ``docs``."""
    scanned = written(scan(docs), "secret-spans")
    limit = F.array(*[F.lit(x) for x in thresholds(scanned)])
    names = F.array(*[F.lit(k) for k in KINDS])
    def joined(keep):
        return F.array_join(F.transform(F.filter("found", keep), lambda f: F.concat_ws(":", names[f["kind"]], f["start"].cast("string"), f["stop"].cast("string"))), ",")
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(joined(lambda f: f["kind"] < 3), 256).alias("base_sha256"),
        joined(lambda f: (f["kind"] < 3) | (f["bin"] <= F.get(limit, f["class"]))).alias("spans"))
