"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of tokens (its documents in table order). Each window of
2048 tokens takes from every queue its share of the target mixture; the fraction
of a token that a queue is owed is its deficit and carries into the next window.
The queues, any number, are the leaves of a binary tree of halves. A node that holds
N tokens of a phase, N_l of them in its left half, serves floor(N_l * u / N) of its
first u tokens from the left and the others from the right, the deficit being the
fraction cut off: neither half's takings ever fall, together they are u, and a
queue is off its share by less than a token for each level. Because this is
closed, any task can lay out any window alone from a queue's path in the tree:
deficits carry across windows and partitions without a sequential pass, and no
document is moved.

With ``weights`` given, queues run dry at different times: each drained queue
ends a phase and the rest go on in proportion. Without, the target is the
corpus' own mixture and all queues end together in one phase.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Merges
from .common import cut, slices
from .words import HashedTable

WINDOW = 2048
END_ID = 1


#: Chunks whose tokens need no normaliser: Latin letters, then ASCII marks. The
#: tokenizer lower-cases and splits them into just these two parts. All others are odd.
_MARKS = rb"[.,;:!?%*#$&|()\-]"
_ODD = re.compile(rb"^(?!(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*" + _MARKS + rb"*$).+$", re.M)
_BETWEEN = re.compile(rb"(?<=[a-z\x80-\xbf])(?=" + _MARKS + rb")")


def _lower(raw: bytes) -> bytes:
    """A-Z and U+00C0..U+00DE in lower case; the raw text has no other letters."""
    b = np.frombuffer(raw.lower(), np.uint8).copy()
    after = np.flatnonzero(b[:-1] == 0xC3) + 1
    b[after[(b[after] >= 0x80) & (b[after] <= 0x9E)]] += 0x20
    return b.tobytes()


class WordEncoder:
    """The tokenizer's ids behind a bounded table of white-space-separated chunks.
    Its normaliser turns white space into separators that its splitter removes, so
    the ids of a text are those of its chunks one after another. Parts of plain
    chunks are merged together (``bpe``); any other chunk goes to the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges(max(vocab.values()) + 1, [(vocab[a], vocab[b], i, vocab[a + b]) for i, (a, b) in enumerate(merges)])
        end = model["end_of_word_suffix"] or ""
        char = _byte_chars()
        self.inner = np.array([vocab[c] for c in char], np.int64)
        self.final = np.array([vocab[c + end] for c in char], np.int64)
        small = max(vocab.values()) < 65536
        self.parts = HashedTable(self._merge, np.uint16 if small else np.uint32)
        self.table = HashedTable(self._encode, np.uint16 if small else np.uint32)

    def _merge(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], np.int64)
        sym = self.inner[raw]
        last = np.cumsum(size) - 1
        sym[last] = self.final[raw[last]]
        sym, word = self.merges.merge(sym, np.repeat(np.arange(len(parts)), size))
        return sym, np.bincount(word, minlength=len(parts))

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        odd = np.searchsorted(starts, [m.start() for m in _ODD.finditer(b"\n".join(words))]).tolist()
        plain = list(words)
        for i in odd:
            plain[i] = b""
        ids, n = self.parts.flat_ids(_BETWEEN.sub(b" ", _lower(b"\n".join(plain))).split(b"\n"))
        owner = [np.repeat(np.arange(len(words)), n)]
        ids = [ids]
        for i in range(0, len(odd), 10_000):
            part = odd[i:i + 10_000]
            found = [e.ids for e in self.tok.encode_batch([words[k].decode() for k in part], add_special_tokens=False)]
            owner.append(np.repeat(part, [len(x) for x in found]))
            ids.append(np.array([y for x in found for y in x], np.int64))
        owner = np.concatenate(owner).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(ids)[order], np.bincount(owner, minlength=len(words))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.append(x, x.dtype.type(END_ID)) for x in self.table.ids(texts)]


def _byte_chars() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes as themselves, the others
    from U+0100 on, in byte order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@lru_cache(1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenised(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, source_col: str | None) -> DataFrame:
    """(pid, k, doc_id, source, at, n, ids): ids little-endian unsigned 32-bit; at:
    tokens of the same source before the row in its partition."""
    source = F.coalesce(docs[source_col].cast("string"), F.lit("")) if source_col else F.lit("")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       source.alias("source"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        pid, enc, held, k = TaskContext.get().partitionId(), encoder(tokenizer), {}, 0
        for pdf in slices(batches, budget=2 << 20):
            ids = enc(pdf.text.tolist())
            at = []
            for s, x in zip(pdf.source, ids):
                at.append(held.get(s, 0))
                held[s] = at[-1] + len(x)
            yield pd.DataFrame({"pid": pid, "k": np.arange(k, k + len(pdf)), "doc_id": pdf.doc_id.astype("Int64"),
                                "source": pdf.source, "at": at, "n": [len(x) for x in ids],
                                "ids": [x.astype("<u4").tobytes() for x in ids]})
            k += len(pdf)

    return cut(rows.mapInPandas(encode, "pid int, k long, doc_id long, source string, at long, n long, ids binary"),
               "pack-tokens")


def phases(totals: list[int], weights: list[float] | None) -> list[tuple[int, list[int], list[int]]]:
    """(first token, tokens served before by queue, tokens served within by queue) of
    each phase; a phase ends when a queue runs dry."""
    left, out, served, t = list(totals), [], [0] * len(totals), 0
    while sum(left):
        live = [s for s, n in enumerate(left) if n and weights and weights[s] > 0]
        take = list(left)  # no target (left): in the proportions there are
        if live:
            f = min(left[s] / weights[s] for s in live)
            part = [0] * len(left)
            for s in live:
                part[s] = min(left[s], int(f * weights[s] + 0.5))
            take = part
            if not sum(part):
                for s in live:
                    take[s] = left[s]
        out.append((t, list(served), take))
        served = [a + b for a, b in zip(served, take)]
        left = [a - b for a, b in zip(left, take)]
        t += sum(take)
    return out


class Layout:
    """Tokens that each queue has been served after t tokens of the output."""

    def __init__(self, totals: list[int], weights: list[float] | None):
        self.phases, self.total, self.queues = phases(totals, weights), sum(totals), len(totals)
        self.starts = [p[0] for p in self.phases]
        # Sums over the queues before each, of the tokens served before and within a phase.
        self.sums = [(list(accumulate(before, initial=0)), list(accumulate(take, initial=0))) for _, before, take in self.phases]
        self.place = lru_cache(200_000)(self._place)

    def _place(self, s: int, t: int) -> tuple[int, int]:
        """(tokens of the queues before s, tokens of s) among the first t tokens."""
        t = min(t, self.total)
        i = max(0, bisect_right(self.starts, t) - 1)
        t0, before, _ = self.phases[i]
        earlier, held = self.sums[i]
        u, first, lo, hi = t - t0, 0, 0, self.queues
        while hi - lo > 1 and u:
            mid = (lo + hi) // 2
            left = u * (held[mid] - held[lo]) // (held[hi] - held[lo])
            if s < mid:
                hi, u = mid, left
            else:
                lo, first, u = mid, first + left, u - left
        return earlier[s] + first, before[s] + u

    def served(self, t: int) -> tuple[int, ...]:
        return tuple(self.place(s, t)[1] for s in range(self.queues)) if self.phases else (0,) * self.queues

    def first_window(self, s: int, g: int) -> int:
        """The window that serves token g of queue s: from where its share puts it."""
        i = bisect_right(self.phases, g, key=lambda p: p[1][s]) - 1
        t0, before, take = self.phases[i]
        lo = hi = min(t0 + (g - before[s]) * self.sums[i][1][-1] // max(1, take[s]), self.total - 1) // WINDOW
        step = 1
        while lo and self.place(s, lo * WINDOW)[1] > g:
            lo, step = max(0, lo - step), step * 2
        step = 1
        while self.place(s, (hi + 1) * WINDOW)[1] <= g:
            hi, step = hi + step, step * 2
        while lo < hi:
            mid = (lo + hi) // 2
            if self.place(s, (mid + 1) * WINDOW)[1] > g:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def pieces(self, s: int, g: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, window, offset in window) of tokens [g, g+n) of queue s."""
        w, at = self.first_window(s, g), g
        while at < g + n:
            (first_a, a), (first_b, b) = self.place(s, w * WINDOW), self.place(s, (w + 1) * WINDOW)
            if b <= at:  # a small queue has nothing in many windows
                w = self.first_window(s, at)
                continue
            end = min(b, g + n)
            yield at - g, end - at, w, first_b - first_a + at - a
            at = end
            w += 1


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         source_col: str | None = "source", weights: dict[str, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source.

    Every id of every document (its tokens, then id 1) lies in exactly one piece;
    every window but the last is full, so padding is less than one window in all.
    A null text is empty (one token); a null source is the queue of the empty
    name; repeated rows are packed each; documents of any length are cut at
    windows; an empty table gives no rows. ``weights``: target share by source
    (default: the corpus' own); sources without a weight follow at the end.
    """
    tok = tokenised(docs, tokenizer, id_col, text_col, source_col)
    by_part = tok.groupBy("pid", "source").agg(F.sum("n").alias("n"))
    # One row per source: all the driver gathers, and the layout needs.
    queues = [(r.source, int(r.n)) for r in by_part.groupBy("source").agg(F.sum("n").alias("n")).collect()]
    queues.sort(key=lambda q: (-q[1], q[0]))
    number = {s: i for i, (s, _) in enumerate(queues)}
    totals = [n for _, n in queues]
    target = None if weights is None else [weights.get(s, 0.0) for s, _ in queues]
    # Sums of partitions before this one, by source: one row per partition and source.
    before = by_part.select("pid", "source", (F.sum("n").over(
        Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    placed = tok.join(cut(before, "pack-before"), ["pid", "source"])  # known to be small: no token is shuffled

    def cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layout = Layout(totals, target)
        for pdf in batches:
            out = []
            for d, s, g, n, ids in zip(pdf.doc_id, pdf.source, pdf.before + pdf["at"], pdf.n, pdf.ids):
                d = None if pd.isna(d) else int(d)
                for start, length, w, off in layout.pieces(number[s], int(g), int(n)):
                    out.append((d, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n, w, off, s))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                             "sequence_id", "offset", "source"]).astype({"doc_id": "Int64"})

    return placed.select("doc_id", "source", "before", "at", "n", "ids").mapInPandas(
        cut_rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                  "sequence_id long, offset long, source string")
