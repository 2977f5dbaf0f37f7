"""Substring dedup with a compressed FM-index per shard.

A window is 13 consecutive words. It is removed when its words also start in a
document of a smaller id. To judge windows without comparing all documents:

1. Anchors. Every window has an anchor, the smallest hash among its 6-word
   grams; neighbouring windows mostly share one, so a document has few anchors
   (segments). Equal windows have equal anchors. Tasks count in how many
   documents an anchor occurs; segments whose anchor occurs in one document
   only cannot repeat and stay at home.
2. Routing. Live segments go to the shard of the smallest document that has the
   anchor (neighbouring segments of the same owner as one interval). Anchors in
   very many documents would crowd one shard: their windows go one by one to the
   shard of their own words instead. Whatever one task holds twice leaves it
   once: the smallest document's copy goes, the other copies are removed there.
3. Index. A shard's intervals make one text; its Burrows-Wheeler transform is
   kept in a wavelet matrix of packed bits with sampled counts. The intervals
   stream through it from right to left: a backward step adds a word, dropping
   the last one widens the range to that of the 12-word prefix. Each matching
   statistic of length 13 is a range of rows; its smallest document decides.
4. Words covered by removed windows leave their documents.

Documents are dealt into bounded buckets once; the steps read that exchange
again. Nothing whole passes through one task: anchors of more than a thousandth
of the documents (a bounded set) are known beforehand and never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import HashedWords, grams, split

WINDOW = 13
ANCHOR = 6
#: An anchor in more than this share of the documents is known to all tasks.
COMMON_SHARE = 0.001
COMMON_IN_SLICE = 3
#: Segments of an anchor in more documents than this are routed window by window.
CROWD = 1000
BUCKET_DOCS = 1000
SHARD_DOCS = 2000
LANE = 64
NO_ID = np.iinfo(np.int64).max

PAYLOAD = "key long, kind int, a binary, b binary, c binary, d binary, e binary"
KEPT, ENTRIES, LIVE, TEXTS, GONE = range(5)


# ---------------------------------------------------------------- windows and anchors
def segments(h: np.ndarray, counts: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """(text number, first window, windows, anchor hash) of maximal runs of windows with
    the same anchor, over texts laid out one after another."""
    span = window - anchor + 1
    total = len(h) - window + 1
    if total <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    g = grams(h, anchor)
    views = np.lib.stride_tricks.sliding_window_view(g, span)
    at = np.empty(total, np.int64)
    for i in range(0, total, 1 << 18):
        at[i:i + (1 << 18)] = views[i:i + (1 << 18)].argmin(axis=1)
    at += np.arange(total)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)[:total]
    ok = np.arange(total) + window <= ends[doc]
    i = np.flatnonzero(ok)
    if not len(i):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    new = np.r_[True, (at[i][1:] != at[i][:-1]) | (doc[i][1:] != doc[i][:-1])]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(i)])
    starts = i[first]
    return doc[starts], starts - (ends - counts)[doc[starts]], size, g[at[starts]]


# ---------------------------------------------------------------- the index
class Bits:
    """Packed bits with counts before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        per = np.bitwise_count(self.words).astype(np.uint32)
        self.before = (np.cumsum(per) - per).astype(np.uint32)
        self.ones = int(per.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & low)


class FMIndex:
    """FM-index of a text of symbols 0..sigma-1, read as a circle, sorted by the
    first ``depth`` symbols: backward search is exact for patterns up to that length."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int = WINDOW):
        n = self.n = len(text)
        self.depth = depth
        rank, have = text.astype(np.int64), 1
        while have * 2 <= depth:
            rank, have = _dense(rank * (rank.max(initial=0) + 1) + np.roll(rank, -have)), have * 2

        def prefix(m: int) -> np.ndarray:  # the order of the first m symbols, have <= m <= 2 have
            return rank * (rank.max(initial=0) + 1) + np.roll(rank, have - m) if m > have else rank

        full = prefix(depth)
        self.suffixes = np.argsort(full, kind="stable")
        full, short = full[self.suffixes], prefix(depth - 1)[self.suffixes]
        self.run = np.cumsum(np.r_[False, full[1:] != full[:-1]]) if n else np.zeros(0, np.int64)
        edge = np.flatnonzero(np.r_[True, short[1:] != short[:-1], True])  # ranges of depth-1 prefixes
        which = np.cumsum(np.r_[False, short[1:] != short[:-1]])
        self.wide_lo, self.wide_hi = edge[which], edge[which + 1]
        last = text[self.suffixes - 1]
        self.levels: list[tuple[Bits, int]] = []
        width = max(1, int(sigma - 1).bit_length())
        at = last
        for k in range(width - 1, -1, -1):
            bit = (at >> k) & 1
            b = Bits(bit)
            self.levels.append((b, n - b.ones))
            at = np.concatenate([at[bit == 0], at[bit == 1]])
        self.width = width
        symbols = np.arange(sigma)
        self.base = self._descend(symbols, np.zeros(sigma, np.int64))
        self.first = np.searchsorted(np.sort(text), symbols)

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in zip(range(self.width - 1, -1, -1), self.levels):
            ones = bits.rank1(i)
            i = np.where((c >> k) & 1 == 1, zeros + ones, i - ones)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of c + pattern from the ranges of pattern."""
        both = self._descend(np.concatenate([c, c]), np.concatenate([lo, hi])) - np.tile(self.base[c], 2)
        return self.first[c] + both[:len(c)], self.first[c] + both[len(c):]

    def widen(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the pattern without its last symbol, given a row of a full-length range."""
        return self.wide_lo[row], self.wide_hi[row]


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def matching_minima(texts: list[np.ndarray], owners: np.ndarray, sigma: int, window: int = WINDOW) -> list[np.ndarray]:
    """For every window of each text (symbols 1..sigma-1) the smallest owner among the
    texts that hold it, by streaming the texts backward through their FM-index."""
    lens = np.array([len(t) for t in texts], np.int64)
    text = np.concatenate([x for t in texts for x in (t, np.zeros(1, np.int64))])
    at = np.cumsum(lens + 1) - (lens + 1)
    index = FMIndex(text, sigma, window)
    owner = np.repeat(np.asarray(owners, np.int64), lens + 1)[index.suffixes]
    starts = np.flatnonzero(np.r_[True, index.run[1:] != index.run[:-1]])
    least = np.minimum.reduceat(owner, starts)
    # Lanes: up to LANE windows of one text each, all streamed in step.
    windows = lens - window + 1
    lanes = -(-windows // LANE)
    of = np.repeat(np.arange(len(texts)), lanes)
    begin = (np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
    size = np.minimum(LANE, windows[of] - begin)
    order = np.argsort(-size, kind="stable")
    of, begin, size = of[order], begin[order], size[order]
    last = at[of] + begin + size - 1  # the lane's rightmost window
    lo, hi = np.zeros(len(of), np.int64), np.full(len(of), index.n, np.int64)
    for j in range(window - 1, 0, -1):  # all but the window's first word
        lo, hi = index.extend(text[last + j], lo, hi)
    found = np.empty(len(text), np.int64)
    for step in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -step, side="left"))  # lanes with more windows than steps done
        if live < len(lo):
            lo, hi = lo[:live], hi[:live]
        here = last[:live] - step
        lo, _ = index.extend(text[here], lo, hi)
        found[here] = least[index.run[lo]]
        lo, hi = index.widen(lo)
    return [found[a:a + w] for a, w in zip(at, windows)]


# ---------------------------------------------------------------- payloads between steps
def _pack(*arrays) -> list[bytes]:
    return [x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes() for x in arrays]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(*r, *[b""] * (7 - len(r))) for r in rows], columns=["key", "kind", "a", "b", "c", "d", "e"])


def _column(pdf: pd.DataFrame, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(pdf[name]), dtype)


def _by_key(keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    if len(keys):
        order = np.argsort(keys, kind="stable")
        keys, columns = keys[order], [c[order] for c in columns]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        for lo, hi in zip(first, np.r_[first[1:], len(keys)]):
            yield int(keys[lo]), *[c[lo:hi] for c in columns]


def _removals(bucket_of, rows: list[tuple[int, int, int]]) -> list[tuple]:
    """(row key, first word, words) as payload rows for the documents' buckets."""
    if not rows:
        return []
    x = np.array(rows, np.int64)
    return [(-1 - b, GONE, *_pack(*c)) for b, *c in _by_key(bucket_of(x[:, 0]), x[:, 0], x[:, 1], x[:, 2])]


# ---------------------------------------------------------------- the steps
def common_anchors(rows: DataFrame, share: float, total: int) -> np.ndarray:
    """Anchors of more than about ``share`` of all documents; both kinds of routing are
    exact, so a count that misses slices where an anchor is rare does no harm."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = HashedWords()
        for pdf in slices(batches, budget=1 << 20):
            h, _, counts = words(pdf.text.tolist())
            doc, _, _, m = segments(h, counts)
            pairs = np.unique(np.stack([m, doc.astype(np.uint64)]), axis=1)[0] if len(m) else m
            s, c = np.unique(pairs, return_counts=True)
            often = c >= COMMON_IN_SLICE
            yield pd.DataFrame({"m": s[often].astype(np.int64), "n": c[often]})

    top = (rows.mapInPandas(count, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
           .where(F.col("n") > max(CROWD / 10, share * total)).select("m").toPandas())
    return np.sort(top.m.to_numpy(np.int64).astype(np.uint64))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", common_share: float = COMMON_SHARE,
                   crowd: int = CROWD, shard_docs: int = SHARD_DOCS, outputs: bool = True,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, with
    ``outputs``, kept_text (the kept words joined by one space) and spans (removed
    [first word, words], ascending); ``carry`` names atomic columns of ``docs`` to
    return beside them.

    Words are [^\\x20\\x09-\\x0D]+, unchanged. Null and empty texts have none; texts
    of fewer than 13 words lose nothing; windows repeated within one document stay;
    repeated rows of one id keep theirs alike; rows without id count as after all
    ids (they lose what any document with an id has, and spare one another); texts
    of any length are judged whole; an empty table gives no rows.
    """
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       *[docs[c].cast("string").alias(f"carry_{i}") for i, c in enumerate(carry) if c != text_col],
                       *[docs[text_col].isNull().alias("no_text")] * (text_col in carry))
    full = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = full.select("doc_id", "text", "row")
    total = rows.count()
    buckets, shards = max(16, -(-total // BUCKET_DOCS)), max(16, -(-total // shard_docs))
    common = common_anchors(rows, common_share, total)

    def bucket_of(row: np.ndarray) -> np.ndarray:
        return row.astype(np.uint64) % np.uint64(buckets)

    def is_common(m: np.ndarray) -> np.ndarray:
        return common[np.minimum(np.searchsorted(common, m), len(common) - 1)] == m if len(common) else np.zeros(len(m), bool)

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = HashedWords()
        for pdf in slices(batches, budget=1 << 20):
            h, _, counts = words(pdf.text.tolist())
            doc, start, size, m = segments(h, counts)
            ids, row = pdf.doc_id.to_numpy()[doc], pdf.row.to_numpy()[doc]
            hot = is_common(m)
            out = [(-1 - b, LIVE, *_pack(r, s, n, np.full(len(r), -1, np.int64)))
                   for b, r, s, n in _by_key(bucket_of(row[hot]), row[hot], start[hot], size[hot])]
            ids, row, start, size, m = (x[~hot] for x in (ids, row, start, size, m))
            out += [(k, ENTRIES, *_pack(*c)) for k, *c in
                    _by_key((m % np.uint64(shards)).astype(np.int64), m, ids, row, start.astype(np.int32), size.astype(np.int16))]
            yield _frame(out)

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.kind.iloc[0] != ENTRIES:
            return pdf
        m, ids, row = _column(pdf, "a", np.uint64), _column(pdf, "b", np.int64), _column(pdf, "c", np.int64)
        start, size = _column(pdf, "d", np.int32).astype(np.int64), _column(pdf, "e", np.int16).astype(np.int64)
        _, which, n = np.unique(m, return_inverse=True, return_counts=True)
        low, high = np.full(len(n), NO_ID), np.full(len(n), np.iinfo(np.int64).min)
        np.minimum.at(low, which, ids)
        np.maximum.at(high, which, ids)
        live = (low < high)[which]
        # The owner routes; -1: too many documents, route window by window.
        owner = np.where(n > crowd, -1, low)[which]
        return _frame([(-1 - b, LIVE, *_pack(*c)) for b, *c in
                       _by_key(bucket_of(row[live]), row[live], start[live], size[live], owner[live])])

    def texts_out(key, docs_: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        if not len(marks) or not len(docs_):
            return _frame([])
        row, start = _column(marks, "a", np.int64), _column(marks, "b", np.int64)
        size, owner = _column(marks, "c", np.int64), _column(marks, "d", np.int64)
        by_row = {r: c for r, *c in _by_key(row, start, size, owner)}
        held: dict[tuple[int, bytes], list] = {}  # (shard, words) -> [smallest id, its places, other places]
        for r, d, text in docs_.drop_duplicates("row")[["row", "doc_id", "text"]].itertuples(index=False):
            if r not in by_row:
                continue
            ws = split(text)
            for first, n_windows, shard in intervals(*by_row[r]):
                if shard < 0:
                    for i in range(first, first + n_windows):
                        w = b" ".join(ws[i:i + WINDOW])
                        _hold(held, (xxhash.xxh64_intdigest(w) % shards, w), d, r, i)
                else:
                    _hold(held, (shard % shards, b" ".join(ws[first:first + n_windows + WINDOW - 1])), d, r, first)
        gone, out = [], {}
        for (shard, text), (least, places, others) in held.items():
            length = text.count(b" ") + 1
            gone += [(r, i, length) for r, i in others]
            for r, i in places:
                out.setdefault(shard, []).append((least, r, i, text))
        sent = [(k, TEXTS, *_pack(*(np.array(x, np.int64) for x in list(zip(*v))[:3]), b"\n".join(x[3] for x in v)))
                for k, v in out.items()]
        return _frame(sent + _removals(bucket_of, gone))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.kind.iloc[0] != TEXTS:
            return pdf
        ids, row, start = (_column(pdf, c, np.int64) for c in "abc")
        number: dict[bytes, int] = {}
        symbols = [np.array([number.setdefault(w, len(number) + 1) for w in t.split(b" ")], np.int64)
                   for x in pdf.d for t in x.split(b"\n")]
        least = matching_minima(symbols, ids, len(number) + 1)
        gone = []
        for d, r, s, m in zip(ids.tolist(), row.tolist(), start.tolist(), least):
            hit = np.flatnonzero(m < d)
            if len(hit):
                first = np.flatnonzero(np.r_[True, np.diff(hit) > WINDOW])
                for lo, hi in zip(first, np.r_[first[1:], len(hit)]):
                    gone.append((r, s + hit[lo], hit[hi - 1] - hit[lo] + WINDOW))
        return _frame(_removals(bucket_of, gone))

    def finish(key, docs_: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        by_row = {}
        if len(marks):
            by_row = {r: (s, n) for r, s, n in
                      _by_key(*(_column(marks, c, np.int64) for c in "abc"))}
        out = []
        carried = [f"carry_{i}" for i in range(len(carry))]
        if text_col in carry:  # the text travels once
            docs_[f"carry_{carry.index(text_col)}"] = docs_.text.where(~docs_.no_text.astype(bool), None)
        for r, d, text, *more in docs_[["row", "doc_id", "text", *carried]].itertuples(index=False):
            ws, spans = split(text), []
            n_words = len(ws)
            if r in by_row:
                mark = np.zeros(n_words + 1, np.int64)
                s, n = by_row[r]
                np.add.at(mark, s, 1)
                np.add.at(mark, s + n, -1)
                gone = np.r_[False, np.cumsum(mark)[:-1] > 0, False]
                edge = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)
                spans = [[int(a), int(b - a)] for a, b in edge]
                ws = [w for w, g in zip(ws, gone[1:-1]) if not g]
            kept = b" ".join(ws)
            out.append((None if d == NO_ID else d, n_words, n_words - len(ws), hashlib.sha256(kept).hexdigest())
                       + ((kept.decode("utf-8", "surrogatepass"), spans) if outputs else ()) + tuple(more))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text", "spans"] * outputs + carried
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" \
        + ", kept_text string, spans array<array<long>>" * outputs \
        + "".join(f", carry_{i} string" for i in range(len(carry)))
    if not total:
        return docs.sparkSession.createDataFrame([], schema).toDF(
            *["doc_id", "n_words", "n_removed", "kept_sha256"], *["kept_text", "spans"] * outputs, *carry)
    # Row keys are hashed to buckets as the payloads' keys are: unsigned remainder.
    bucket = F.expr(f"cast(pmod(cast(row as decimal(20,0)) + if(row < 0, 18446744073709551616, 0), {buckets}) as long)")
    dealt = full.withColumn("key", -1 - bucket).groupBy("key")
    live = rows.mapInPandas(anchors, PAYLOAD).groupBy("key").applyInPandas(decide, PAYLOAD)
    sent = dealt.cogroup(live.groupBy("key")).applyInPandas(texts_out, PAYLOAD)
    gone = sent.groupBy("key").applyInPandas(search, PAYLOAD)
    out = dealt.cogroup(gone.groupBy("key")).applyInPandas(finish, schema)
    back = {f"carry_{i}": F.col(f"carry_{i}").cast(docs.schema[c].dataType).alias(c) for i, c in enumerate(carry)}
    return out.select(*[back.get(c, F.col(c)) for c in out.columns])


def _hold(held: dict, key: tuple[int, bytes], d: int, r: int, at: int) -> None:
    """Keeps the smallest id's places of a text; the places of larger ids are removed ones."""
    x = held.get(key)
    if x is None:
        held[key] = [d, [(r, at)], []]
    elif d == x[0]:
        x[1].append((r, at))
    elif d < x[0]:
        x[2] += x[1]
        x[0], x[1] = d, [(r, at)]
    else:
        x[2].append((r, at))


def intervals(start: np.ndarray, size: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first window, windows, owner's route or -1) of neighbouring segments of one owner."""
    order = np.argsort(start, kind="stable")
    start, size, owner = start[order], size[order], owner[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + size[:-1])]
    first = np.flatnonzero(new)
    for lo, hi in zip(first, np.r_[first[1:], len(start)]):
        o = int(owner[lo])
        route = -1 if o == -1 else xxhash.xxh64_intdigest(o.to_bytes(8, "little", signed=True)) >> 1
        yield int(start[lo]), int(start[hi - 1] + size[hi - 1] - start[lo]), route
