"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised alike on both sides: A-Z in lower case, words of ASCII letters
and digits or characters beyond ASCII, everything else a separator. Each run of
``window`` words of a test question or answer (a shorter one as a whole) is a
pattern of the automaton; a document is scanned once, character by character, and
the matches are mapped from the normalised text to words and to code points of the
original.

Patterns are dealt by hash over as many automata as keep each within
``shard_bytes``; only one is held by the driver and the workers at a time. A usual
benchmark needs one. Beyond, each automaton is one further pass over the documents,
with what was found so far carried along and written in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices, texts

WINDOW = 10
#: Bytes that one automaton may take in a worker, at NODE_BYTES for each character of its patterns.
SHARD_BYTES, NODE_BYTES = 64 << 20, 48

#: Byte by byte: A-Z to lower case, other ASCII that is no letter or digit to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def fold(text: str) -> bytes:
    """The text in UTF-8 with separators as spaces; bytes stay where they are."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD)


def _padded(words: Sequence[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def windows(items: DataFrame, item_col: str, text_cols: Sequence[str], window: int) -> DataFrame:
    """(pattern, item): the distinct windows of each item's texts, words between spaces."""
    rows = items.select(items[item_col].cast("string").alias("item"),
                        F.explode(F.array(*[items[c].cast("string") for c in text_cols])).alias("text"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches):
            out: list[tuple] = []
            for item, text in zip(pdf.item, pdf.text):
                words = fold(text).split()
                if words:
                    out += [(_padded(words[i:i + window]), item) for i in range(max(1, len(words) - window + 1))]
            yield pd.DataFrame(out, columns=["pattern", "item"])

    return rows.where("text IS NOT NULL").mapInPandas(build, "pattern binary, item string").distinct()


class Automaton:
    """Finds all patterns in padded normalised words; a pattern's value is its number."""

    def __init__(self, patterns: Sequence[bytes], items: Sequence[str | None]):
        self.trie, self.sizes, self.items = ahocorasick.Automaton(), [], []
        number: dict[bytes, int] = {}
        for pattern, item in zip(patterns, items):
            n = number.setdefault(bytes(pattern), len(number))
            if n == len(self.sizes):
                self.sizes.append(bytes(pattern).count(b" ") - 1)
                self.items.append([])
                self.trie.add_word(bytes(pattern).decode("latin-1"), n)  # one character a byte
            if item is not None:
                self.items[n].append(item)
        if number:
            self.trie.make_automaton()

    def find(self, words: list[bytes]) -> tuple[np.ndarray, list[int]] | None:
        """(which words are hit, numbers of the patterns that occur); None without any."""
        if not self.sizes or not words:
            return None
        padded = _padded(words)
        found = list(self.trie.iter(padded.decode("latin-1")))
        if not found:
            return None
        ends, numbers = np.array(found).T
        last = np.searchsorted(np.flatnonzero(np.frombuffer(padded, np.uint8) == 32), ends)  # words before the end
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, last - np.array(self.sizes)[numbers], 1)
        np.add.at(edge, last, -1)
        return np.cumsum(edge[:-1]) > 0, np.unique(numbers).tolist()


_BUILT: dict = {}


def _automaton(shared, name: str) -> Automaton:
    """The worker's automaton of a broadcast: built once, the one before let go."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(*shared.value)
    return _BUILT[name]


def spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as {begin, end} in code points of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    letter = np.frombuffer(raw.translate(_FOLD), np.uint8) != 32
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    run = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    point = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"begin": int(point[begin[a]]), "end": int(point[end[b - 1]])} for a, b in zip(run[::2], run[1::2])]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_texts: Sequence[str] = ("text",),
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit (words inside an occurrence of a window), items (ids of
    the items with an occurring window, as sorted strings), spans (runs of hit words:
    begin, end in code points of the original text), one row per row of ``docs``.

    Null and empty texts have no words, on either side; an item of fewer than
    ``window`` words is one window, one without words none. Windows don't cross from
    one of ``item_texts`` to the next. Items of one id count once; a null item id
    hits words but is not listed. Repeated rows and null ids of ``docs`` are rows
    like any other; further columns of either table are not read.
    """
    spark = docs.sparkSession
    patterns = cut(windows(items, item_col, item_texts, window), "leak-windows")
    size = patterns.agg(F.sum(F.length("pattern") * NODE_BYTES + 32)).first()[0] or 0
    count = max(1, -(-size // shard_bytes))
    rows = texts(docs, id_col, text_col).select("*", F.lit(None).cast("binary").alias("hit"),
                                                F.array().cast("array<string>").alias("items"))
    for shard in range(count):
        held = patterns.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(count)) == shard).toPandas()
        shared = spark.sparkContext.broadcast((list(held.pattern), list(held["item"])))
        last = shard == count - 1
        rows = rows.mapInPandas(_scanner(shared, last), _FOUND if last else rows.schema)
        if not last:
            rows = cut(rows, "leak-pass")
    return rows


_FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<begin: int, end: int>>"


def _scanner(shared, last: bool):
    name = uuid.uuid4().hex

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared, name)
        for pdf in slices(batches):
            n_words, hits, items = [], [], []
            for text, hit, before in zip(pdf.text, pdf.hit, pdf["items"]):
                words = fold(text).split()
                mask = None if hit is None else np.frombuffer(hit, bool)
                found = automaton.find(words)
                listed = set(before)
                if found:
                    mask = found[0] if mask is None else mask | found[0]
                    listed.update(i for n in found[1] for i in automaton.items[n])
                n_words.append(len(words))
                hits.append(mask)
                items.append(sorted(listed))
            if last:
                yield pd.DataFrame({"doc_id": pdf.doc_id, "n_words": n_words, "items": items,
                                    "n_hit": [0 if m is None else int(m.sum()) for m in hits],
                                    "spans": [[] if m is None else spans(t, m) for t, m in zip(pdf.text, hits)]})
            else:
                yield pdf.assign(hit=[None if m is None else m.tobytes() for m in hits], items=items)

    return scan
