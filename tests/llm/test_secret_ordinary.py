"""Secret scan: the ordinary strings are those of all texts, whatever the batches."""
import numpy as np
import pyarrow as pa

from llm import secret_scan
from llm import words as W


def test_every_text_is_cut_by_every_length():
    texts = [("The quick Brown fox, " * k) + "é" * k for k in (0, 1, 4, 9, 30)] + [None, "x"]
    whole = secret_scan._ordinary(*W.text_bytes(pa.array(texts)))
    parts = sum(secret_scan._ordinary(*W.text_bytes(pa.array(t, pa.string()))) for t in (texts[:2], texts[2:4], texts[4:]))
    assert (whole == parts).all()
    letters = [sum(c.isascii() and c.isalpha() for c in t or "") for t in texts]
    assert whole.sum(axis=1).tolist() == [sum(m // n for m in letters) for n in secret_scan.LENGTHS]
    assert (secret_scan._ordinary(np.zeros(0, np.uint8), np.zeros(1, np.int64)) == 0).all()
