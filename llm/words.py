"""Words of whole texts as 64-bit hashes, a record batch at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All arithmetic is
modulo 2**64 on numpy arrays. A word's hash is a polynomial over a random
value per byte, finished with a mixing step and its length; it is a function
of the word's bytes alone. Work arrays cover at most ``PIECE`` bytes of text
(one longer word: that word), however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
SLICE = 4 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= PIECE + 4096:
            _POWERS[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start byte, end byte) of every word."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = off[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(off, starts, "right") - 1, starts, ends


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of every word; ``lower``: A-Z count as a-z."""
    values, out = _BYTE_LOWER if lower else _BYTE, np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        base, top = starts[i], ends[j - 1]
        n = int(top - base)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[raw[base:top]] * _powers(_R, n), out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        h = (sums[e] - sums[s]) * _powers(_R_INV, n)[s]
        out[i:j] = mix(h + (e - s).astype(np.uint64) * _GRAM)
        i = j
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 words have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = hashes[:n].copy()
    for j in range(1, k):
        acc *= _GRAM
        acc += hashes[j:j + n]
    return mix(acc + np.uint64(k))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        total, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def per_row(rows: np.ndarray, n: int) -> np.ndarray:
    """Index of each row's first word, and the number of words at the end."""
    return np.searchsorted(rows, np.arange(n + 1))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
