"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Words (a run of spaces and what follows up to the next space or line feed) can't
merge across their borders: no piece holds a space after another character, and
none a line feed; both are verified when the model is read. The words that a
worker has not met yet become one flat array of symbols and are merged together
(``bpe``); characters without a piece fall back to their bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .bpe import Merges
from .common import WordTable, gather, slices, texts

SPACE = "▁"
_WORDS = re.compile(r" +[^ \n]*|\n|[^ \n]+")


class PieceModel:
    """Tables read from a model through the library's accessors; the merges and
    the decoding are done here."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        ids = {pieces[i]: i for i in plain}
        for p in ids:
            if SPACE in p.lstrip(SPACE) or "\n" in p or any(c not in ids for c in p):
                raise ValueError(f"the word rule does not hold for piece {p!r}")
        order = sorted(plain, key=lambda i: (-sp.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        chars = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
        self.char_cp, self.char_id = (np.array(x, dtype=np.int64) for x in zip(*chars))
        self.merges = Merges(n, [(ids[p[:k]], ids[p[k:]], rank[i], i) for p, i in ids.items()
                                 for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids])
        out = [b""] * n
        for i in plain:
            out[i] = pieces[i].replace(SPACE, " ").encode()
        out[sp.unk_id()] = " ⁇ ".encode()
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        self.out_len = np.array([len(x) for x in out])
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out = np.frombuffer(b"".join(out), dtype=np.uint8)
        self._plain = set(plain)
        self._table = WordTable(lambda words: self.merge([w.replace(" ", SPACE) for w in words]), np.int32, 1_000_000)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word)."""
        cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        at = np.searchsorted(self.char_cp, cp)
        at[at == len(self.char_cp)] = 0
        sym = np.where(self.char_cp[at] == cp, self.char_id[at], -1 - cp)  # below 0: no piece, never merges
        sym, word = self.merges.merge(sym, np.repeat(np.arange(len(words)), [len(w) for w in words]))
        if (sym < 0).any():
            word, sym = self._fall_back(word, sym)
        return sym.astype(np.int32), np.bincount(word, minlength=len(words))

    def _fall_back(self, word: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as their UTF-8 bytes."""
        odd = np.flatnonzero(sym < 0)
        raw = [chr(-1 - s).encode("utf-8", "surrogatepass") for s in sym[odd]]
        times = np.ones(len(sym), np.int64)
        times[odd] = [len(r) for r in raw]
        out, w = np.repeat(sym, times), np.repeat(word, times)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return w, out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with begin and end ids. A text without characters has no others."""
        ids = self._table.ids([_WORDS.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts])
        return [np.concatenate([[self.bos], x, [self.eos]]).astype("<u4") for x in ids]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: control ids are silent, the leading space of the first
        piece goes, bytes that are no UTF-8 become U+FFFD each."""
        raw = gather(self.out, self.out_at[ids], self.out_len[ids]).tobytes()
        said = np.flatnonzero(self.out_len[ids])
        if len(said) and raw[:1] == b" " and ids[said[0]] in self._plain:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _lenient(raw)


def _lenient(raw: bytes) -> str:
    out, i = [], 0
    while i < len(raw):
        b = raw[i]
        n = 1 if b < 0x80 else 2 if b >> 5 == 6 else 3 if b >> 4 == 14 else 4 if b >> 3 == 30 else 0
        try:
            out.append(raw[i:i + n].decode() if n else "�")
            i += n or 1
        except UnicodeDecodeError:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  outputs: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), decoded text,
    n_tokens, ids_sha256, decoded_sha256; without ``outputs`` only the id and the digests.

    A null text is empty (begin and end ids, decoded ""); repeated rows give
    repeated results; an empty table none; texts of any length are encoded whole.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for pdf in slices(batches):
            ids = m.encode(pdf.text.tolist())
            back = [m.decode(x) for x in ids]
            out = pd.DataFrame({"doc_id": pdf.doc_id.astype("Int64"), "n_tokens": [len(x) for x in ids],
                                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                                "decoded_sha256": [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in back]})
            yield out.assign(ids=[x.astype("int32") for x in ids], decoded=back) if outputs else out

    return texts(docs, id_col, text_col).mapInPandas(run, schema + ", ids array<int>, decoded string" * outputs)
