"""BPE encoding by dynamic programming over prefixes.

The BPE encoding of a text's prefix ends in one token only, and dropping that
token leaves the BPE encoding of a shorter prefix. So it is enough to store
the last token of every prefix: of the vocabulary's tokens that match as a
suffix of the prefix (all found in one pass of a suffix automaton), it is the
one that is compatible with the stored last token of the prefix before it. A
pair (u, v) is compatible when merging u's and v's text anew gives u, v again;
that is decided by undoing the later of the two merges next to the border
again and again and looking for a merge over the border that would have come
first. Following the stored tokens back from the end gives the ids.

No merge crosses the pieces that the vocabulary file's pre-tokenizer cuts, so
the programme runs once per distinct piece of a worker; the ids of frequent
pieces are kept in a table of bounded size (two generations of ``KEEP``).

The normalizer and pre-tokenizer of the file are done here for texts of
code points below U+0250; texts with others go through the
file's own normalizer and pre-tokenizer, as Unicode tables differ between
libraries. Special tokens in a text count as such; decoding joins the token
strings by one space, as the file names no decoder.

Defined cases: null text is an empty text; an empty text has no tokens, the
hash of no bytes, and decodes to an empty text; rows may repeat; extra
columns are ignored. Texts of any length go through whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import releasing

KEEP = 100_000
#: Pairs of tokens whose compatibility a worker remembers.
KEEP_PAIRS = 200_000
#: Fixed value: the only pre-tokenizer pattern that is known here.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = 0x10000  # added to the code point of a piece's last character


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [chr(hidden.get(b, b)) for b in range(256)]


class PrefixBPE:
    """Encoder for one vocabulary file (its JSON text)."""

    def __init__(self, vocabulary: str):
        import ahocorasick
        import regex

        spec = json.loads(vocabulary)
        model = spec["model"]
        kinds = [x.get("pattern", {}).get("Regex") for x in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds[0] != PATTERN or spec["decoder"] is not None or model["end_of_word_suffix"] != "</w>":
            raise ValueError("this vocabulary file has other rules than those known here")
        self._file, self._library = vocabulary, None
        self._piece = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}"))
        self._plain = regex.compile("[\x00-" + chr(0x24F) + "]*")
        self._special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self._special)) + ")")
        vocab = model["vocab"]
        self.strings: list[str] = [""] * (max([*vocab.values(), *self._special.values()]) + 1)
        for s, i in [*vocab.items(), *self._special.items()]:
            self.strings[i] = s
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._made: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            u, v, whole = vocab[left], vocab[right], vocab[left + right]
            self._rank[u, v] = rank
            if whole not in self._parts:
                self._parts[whole], self._made[whole] = (u, v), rank
        self._fits: dict[int, bool] = {}
        whole_tokens: dict[int, bool] = {}
        for t in sorted(set(vocab.values()), key=lambda t: self._made.get(t, -1)):
            parts = self._parts.get(t)
            whole_tokens[t] = parts is None or (whole_tokens[parts[0]] and whole_tokens[parts[1]] and self._stays(*parts, self._made[t]))
        self._automaton = ahocorasick.Automaton()
        for s, t in vocab.items():
            if whole_tokens[t]:
                word = s[:-5] + chr(ord(s[-5]) + END) if s.endswith("</w>") and len(s) > 4 else s
                self._automaton.add_word(word, (t, len(word)))
        self._automaton.make_automaton()
        self._chars = byte_alphabet()
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _stays(self, u: int, v: int, before: int) -> bool:
        """No merge over the border of u and v comes ahead of those inside; ``before``: rank from which merges over it don't count."""
        while True:
            over = self._rank.get((u, v))
            if over is not None and over < before:
                return False
            a, b = self._made.get(u, -1), self._made.get(v, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # u was made last: before that its right part stood at the border
                before, u = a, self._parts[u][1]
            else:  # of equal merges the left one comes first, so v was made last
                before, v = b + 1, self._parts[v][0]

    def _encode_piece(self, piece: str) -> bytes:
        chars = self._chars
        word = "".join([chars[b] for b in piece.encode()])
        word = word[:-1] + chr(ord(word[-1]) + END)
        last: list = [(-1, 0)] * (len(word) + 1)
        fits = self._fits
        for end, (t, size) in self._automaton.iter(word):
            if last[end + 1][1]:
                continue
            before = end + 1 - size
            if before:
                u = last[before][0]
                if u < 0:
                    continue
                pair = u << 32 | t
                ok = fits.get(pair)
                if ok is None:
                    ok = self._stays(u, t, 1 << 30)
                    if len(fits) < KEEP_PAIRS:
                        fits[pair] = ok
                if not ok:
                    continue
            last[end + 1] = (t, size)
        out, at = [], len(word)
        while at:
            t, size = last[at]
            out.append(t)
            at -= size
        return array("I", out[::-1]).tobytes()

    def _known(self, piece: str) -> bytes:
        got = self._old.get(piece)
        if got is None:
            got = self._encode_piece(piece)
        if len(self._new) >= KEEP:
            self._old, self._new = self._new, {}
        if len(piece) <= 64:
            self._new[piece] = got
        return got

    def pieces(self, text: str) -> list[str]:
        if self._plain.fullmatch(text):
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            return self._piece.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._file)
        known = self._library
        normal = known.normalizer.normalize_str(text)
        back = {c: b for b, c in enumerate(self._chars)}
        return [bytes(back[c] for c in p).decode() for p, _ in known.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str) -> array:
        ids = array("I")
        for part in self._cut.split(text) if "<|" in text else [text]:
            if part in self._special:
                ids.append(self._special[part])
                continue
            new, known = self._new, self._known
            ids.frombytes(b"".join([new.get(p) or known(p) for p in self.pieces(part)]))
        return ids

    def decode(self, ids) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


_ENCODERS: dict[bytes, PrefixBPE] = {}


def encoder(vocabulary: str) -> PrefixBPE:
    """The worker's encoder of this vocabulary, built once."""
    key = hashlib.sha256(vocabulary.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = PrefixBPE(vocabulary)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row; ``with_ids``: the ids and decoded text too."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded string" if with_ids else "")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one file's text: its size does not follow the data

    def run(batches):
        import sys

        from llm import words as W

        bpe = encoder(shared.value)
        for batch in W.slices(batches, limit=1 << 20):
            n, ids_hash, text_hash, all_ids, texts = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text or "")
                decoded = bpe.decode(ids)
                n.append(len(ids))
                text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids.tolist())
                    texts.append(decoded)
                if sys.byteorder == "big":
                    ids.byteswap()
                ids_hash.append(hashlib.sha256(ids.tobytes()).hexdigest())
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int64())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(run), schema)
