"""Statistics of whole texts, from a byte histogram and the word boundaries of each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType

from llm import words as W
from llm.tables import releasing

#: Characters whose share of a text's bytes is a statistic, by name.
SHARES = {
    "pipe": "|", "bang": "!", "hash": "#", "star": "*", "dollar": "$", "percent": "%", "amp": "&", "angle": "<>",
    "dot": ".", "comma": ",", "colon": ":;", "quote": "\"'", "equals": "=", "slash": "/\\", "at": "@", "under": "_-", "bracket": "()[]{}",
}
_LETTERS = [chr(c) for c in range(97, 123)]
#: Second bytes of two-byte letters (UTF-8 after 0xC3) that tell European languages apart.
_SECOND = {"a_grave": 0xA0, "a_acute": 0xA1, "a_uml": 0xA4, "c_ced": 0xA7, "e_grave": 0xA8, "e_acute": 0xA9, "e_circ": 0xAA,
           "i_acute": 0xAD, "n_tilde": 0xB1, "o_acute": 0xB3, "o_uml": 0xB6, "u_acute": 0xBA, "u_uml": 0xBC, "sharp_s": 0x9F}

QUALITY = ["log_words", "word_bytes", "upper", "digit", "space", "line", "wide", "entropy", "symbol", *SHARES]
LANGUAGE = [*(f"l_{c}" for c in _LETTERS), *_SECOND]
NAMES = [*QUALITY, *LANGUAGE]


def statistics(texts) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, matrix of NAMES); an empty text has zeros."""
    raw, off = W.text_bytes(texts)
    n = len(off) - 1
    rows, starts, _ = W.word_spans(raw, off)
    words = np.bincount(rows, minlength=n).astype(np.int64)
    hist = np.zeros((n, 256))
    for i in range(n):
        if off[i + 1] > off[i]:
            hist[i] = np.bincount(raw[off[i]:off[i + 1]], minlength=256)
    size = np.maximum(hist.sum(axis=1), 1)
    share = hist / size[:, None]
    some = lambda chars: share[:, [ord(c) for c in chars]].sum(axis=1)
    blank = some(" \t\n\x0b\x0c\r")
    safe = np.where(share > 0, share, 1)
    lower = share[:, 97:123] + share[:, 65:91]
    letters = np.maximum(lower.sum(axis=1) + share[:, 0xC3], 1e-9)
    cols = [np.log1p(words), (1 - blank) * hist.sum(axis=1) / np.maximum(words, 1), share[:, 65:91].sum(axis=1),
            share[:, 48:58].sum(axis=1), blank, share[:, 10], share[:, 128:].sum(axis=1), -(safe * np.log2(safe)).sum(axis=1),
            some("#*$%&|<>"), *(some(c) for c in SHARES.values()),
            *(lower / letters[:, None]).T, *(share[:, list(_SECOND.values())] / letters[:, None]).T]
    return words, np.stack(cols, axis=1) if n else np.zeros((0, len(NAMES)))


def with_statistics(df: DataFrame, column: str = "_stats", keep_text: bool = False) -> DataFrame:
    """``df`` and ``column``: struct(words, x array<double>); the text only if asked for."""
    kept = [c for c in df.columns if keep_text or c != "text"]
    schema = df.select(*[f"`{c}`" for c in kept]).schema
    out = schema.add(f"{column}_words", "long").add(column, ArrayType(DoubleType()))

    def run(batches):
        for batch in W.slices(batches):
            words, x = statistics(batch.column(batch.schema.get_field_index("text")))
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(words), lists],
                [*kept, f"{column}_words", column])
    return df.mapInArrow(releasing(run), out)
