"""Phrase collocations by prefix-free parsing.

A text's words are cut into overlapping chunks: a chunk begins where a window of
``max_words - 1`` words hashes to 0 modulo ``SPACING`` (content decides, so equal
passages give equal chunks wherever they stand) and ends with the window that begins
the next one. Equal chunks are one row of a dictionary with their frequency in the
parse. N-grams are counted inside distinct chunks only, weighted by frequency; the
overlap belongs to the chunk that it begins, so a chunk counts the n-grams starting
before its last window.

A phrase can only be frequent if its words and pairs of words are. So words are counted
first, by 64-bit keys, then pairs of frequent words, and last, as texts, all phrases
made of frequent pairs. What is frequent is known to the next pass as a bitmap of
fixed size: a bit set by chance, or two keys that are equal, let a phrase through to
be counted; none is lost. The counts of phrases are those of texts, the counts of
single words those of 64-bit keys.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, slices
from .words import grams, mix

#: Mean distance of chunk beginnings; words after which a chunk is cut in any case.
SPACING, LONGEST = 24, 4096
#: Bits of the filter that each pass gets (fixed), in segments that are packed apart.
FILTER_BITS, SEGMENT_BITS = 26, 17
#: Bits of the keys by which pairs are counted for the filter.
PAIR_BITS = 40
#: Characters of a slice, words hashed at once.
_SLICE, _BLOCK = 4 << 20, 1 << 17

_SPACE, _NEWLINE = 32, 10
#: Byte by byte: A-Z to lower case, tabs to spaces, what ends a piece to a line feed.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else _SPACE if c == 9 else _NEWLINE if c in b".,;:!?\n\x0b\x0c\r" else c
              for c in range(256))
_KEYS = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Pieces:
    """Words of some texts, flat: ``buffer`` holds each word and one byte after it (a
    space, or a line feed where its piece ends), ``start``, ``size``, ``piece`` and
    ``text`` say where a word stands and to which piece and text it belongs."""

    def __init__(self, raws: list[bytes]):
        joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        space = (joined == _SPACE) | (joined == _NEWLINE)
        edge = np.flatnonzero(np.diff(space, prepend=True))
        begin, end = edge[::2], edge[1::2]
        self.size = end - begin
        broken = np.concatenate([np.zeros(1, np.int32), np.cumsum(joined == _NEWLINE, dtype=np.int32)])
        self.piece = broken[begin]
        self.text = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), begin, side="right")
        keep = ~space
        keep[end] = True
        self.buffer = joined[keep]
        self.start = np.cumsum(self.size + 1) - self.size - 1
        last = np.diff(self.piece, append=-1) != 0
        self.buffer[self.start + self.size] = np.where(last, _NEWLINE, _SPACE)
        self.bytes = self.buffer.tobytes()

    def hash(self) -> np.ndarray:
        """A 64-bit hash of each word: the sum of its bytes times a key of their place."""
        blocks = [self._hash(i, min(i + _BLOCK, len(self.size))) for i in range(0, len(self.size), _BLOCK)]
        return np.concatenate(blocks) if blocks else np.zeros(0, np.uint64)

    def _hash(self, a: int, b: int) -> np.ndarray:
        start, size = self.start[a:b] - self.start[a], self.size[a:b]
        place = np.arange(start[-1] + size[-1] + 1) - np.repeat(start, size + 1)
        value = self.buffer[self.start[a]:self.start[a] + len(place)].astype(np.uint64) + np.uint64(1)
        value[start + size] = 0  # the byte after the word
        key, far = _KEYS[place & 255], (place >> 8).astype(np.uint64)
        if far.any():  # places beyond 255 take keys of their own
            key = np.where(far > 0, mix(key + far * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1), key)
        return mix(np.add.reduceat(value * key, start) + size.astype(np.uint64) * np.uint64(0x85EBCA77C2B2AE63))


def _pooled(batches: Iterator[pd.DataFrame], col: str, budget: int) -> Iterator[pd.DataFrame]:
    """Slices of about ``budget`` characters, small batches put together: what repeats
    within a slice leaves the task once."""
    held, size = [], 0
    for pdf in slices(batches, col, budget):
        n = int(pdf[col].str.len().sum())
        if held and size + n > budget:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
        held.append(pdf)
        size += n
    if held:
        yield pd.concat(held, ignore_index=True)


def _encode(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD)


def parse(docs: DataFrame, overlap: int, spacing: int = SPACING) -> DataFrame:
    """The dictionary: (lang, chunk, owned, weight): distinct chunks with the number of
    words that may begin an n-gram there and the frequency in the parse."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _pooled(batches, "text", _SLICE):
            langs = pdf.lang.tolist()
            p = Pieces([_encode(t) for t in pdf.text])
            if not len(p.size):
                continue
            first = np.flatnonzero(np.diff(p.text, prepend=-1))  # the first word of each text
            ends = np.append(first[1:], len(p.size))
            window = grams(p.hash(), overlap)  # windows over the border of two texts are no triggers
            at = np.flatnonzero(window % np.uint64(spacing) == 0)
            end_of = ends[np.searchsorted(first, at, side="right") - 1]
            at = at[at + overlap <= end_of]
            begin = np.unique(np.concatenate([first, at]))
            gap = np.diff(begin, append=len(p.size))
            if (gap > LONGEST).any():
                begin = np.concatenate([np.arange(b, b + g, LONGEST) for b, g in zip(begin.tolist(), gap.tolist())])
            owned = np.diff(begin, append=len(p.size))
            end_of = ends[np.searchsorted(first, begin, side="right") - 1]
            total = np.minimum(begin + owned + overlap, end_of) - begin  # the last chunk owns all it has
            seen: dict[tuple, int] = defaultdict(int)
            lang_of = [langs[i] for i in p.text[begin].tolist()]
            stop = p.start[begin + total - 1] + p.size[begin + total - 1]
            for lang, a, b, n in zip(lang_of, p.start[begin].tolist(), stop.tolist(), owned.tolist()):
                seen[lang, p.bytes[a:b], n] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "chunk", "owned", "weight"])

    found = docs.mapInPandas(chunks, "lang string, chunk binary, owned int, weight long")
    return found.groupBy("lang", "chunk", "owned").agg(F.sum("weight").alias("weight"))


def _lang_keys(langs: list[str]) -> np.ndarray:
    """A 64-bit key of each row's language."""
    code, names = pd.factorize(pd.Series(langs, dtype=object))
    keys = Pieces([b"\x00" + n.encode("utf-8", "surrogatepass").replace(b"\x01", b"\x01\x01")
                   .replace(b" ", b"\x01\x02").replace(b"\n", b"\x01\x03") for n in names]).hash()  # one word each
    return keys[code] if len(names) else np.zeros(0, np.uint64)


class _Grams:
    """The n-grams of a slice of the dictionary: ``at`` where one may begin, 64-bit keys
    of language and words."""

    def __init__(self, pdf: pd.DataFrame):
        self.p = Pieces(list(pdf.chunk))
        self.hashes, text = self.p.hash(), self.p.text
        self.lang = _lang_keys(pdf.lang.tolist())[text]
        self.weight = pdf.weight.to_numpy("int64")[text]
        first = np.searchsorted(text, np.arange(len(pdf)))
        self.owned = np.arange(len(text)) - first[text] < pdf.owned.to_numpy()[text]

    def begins(self, words: int) -> np.ndarray:
        """Whether an n-gram begins at each word: owned by the chunk and within a piece."""
        n = max(0, len(self.hashes) - words + 1)
        return self.owned[:n] & (self.p.piece[:n] == self.p.piece[words - 1:])

    def keys(self, words: int) -> np.ndarray:
        g = grams(self.hashes, words)
        return mix(g + self.lang[:len(g)])

    def distinct(self, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, one place of each, summed weights) of the n-grams at ``at``."""
        keys, one, which = np.unique(keys[at], return_index=True, return_inverse=True)
        return keys, at[one], np.bincount(which, self.weight[at], len(keys)).astype(np.int64)


def _known(bitmap, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bits set."""
    bits = np.frombuffer(bitmap.value, np.uint8)
    place = keys >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)
    return ((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def count_keys(dictionary: DataFrame, words: int, bits: int, known=None) -> DataFrame:
    """(key, f) of the n-grams of ``words`` words by the first ``bits`` bits of their keys,
    those whose words ``known`` (a broadcast bitmap) holds; all without one."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _pooled(batches, "chunk", _SLICE):
            g = _Grams(pdf)
            ok = g.begins(words)
            if known is not None:
                word = _known(known, g.keys(1))
                for j in range(words):
                    ok &= word[j:j + len(ok)]
            keys, _, f = g.distinct(np.flatnonzero(ok), g.keys(words))
            yield pd.DataFrame({"key": (keys >> np.uint64(64 - bits)).view(np.int64), "f": f})

    return dictionary.mapInPandas(count, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def count_phrases(dictionary: DataFrame, max_words: int, pairs) -> DataFrame:
    """(lang, phrase, m, f) of all phrases of m = 2 to ``max_words`` words whose pairs of
    neighbours have their bits set in the broadcast bitmap."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _pooled(batches, "chunk", _SLICE):
            g = _Grams(pdf)
            if not len(g.hashes):
                continue
            live = _known(pairs, g.keys(2))
            langs, p = pdf.lang.to_numpy(object), g.p
            for m in range(2, max_words + 1):
                ok = g.begins(m)
                for j in range(m - 1):
                    ok &= live[j:j + len(ok)]
                if not ok.any():
                    break  # nothing longer either
                _, at, f = g.distinct(np.flatnonzero(ok), g.keys(m))
                last = at + m - 1
                phrases = [p.bytes[a:b].decode("utf-8", "surrogatepass")
                           for a, b in zip(p.start[at].tolist(), (p.start[last] + p.size[last]).tolist())]
                yield pd.DataFrame({"lang": langs[p.text[at]], "phrase": phrases, "m": m, "f": f})

    found = dictionary.mapInPandas(count, "lang string, phrase string, m int, f long")
    return found.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f"))


def word_counts(parts: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, part, count) of single words (lang, part) from the counts of their keys."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = Pieces([_encode(w) for w in pdf.part])
            yield pdf.assign(key=mix(grams(p.hash(), 1) + _lang_keys(pdf.lang.tolist())).view(np.int64))

    found = parts.mapInPandas(keyed, "lang string, part string, key long").join(words, "key")
    return found.select("lang", "part", F.col("f").alias("count"))


def filter_bits(keys: DataFrame, bits: int) -> bytes:
    """The bitmap of keys of so many bits: their places are made distinct and packed segment by segment in
    tasks; the driver gets the segments, a fixed size in all."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << SEGMENT_BITS, bool)
        bits[pdf.place.to_numpy() & ((1 << SEGMENT_BITS) - 1)] = True
        return pd.DataFrame({"segment": [int(pdf.place.iloc[0]) >> SEGMENT_BITS],
                             "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    places = keys.select(F.shiftrightunsigned("key", bits - FILTER_BITS).alias("place")).distinct()
    packed = places.groupBy(F.shiftright("place", SEGMENT_BITS).alias("segment")).applyInPandas(
        pack, "segment long, bits binary").toPandas()
    out = np.zeros((1 << FILTER_BITS - SEGMENT_BITS, 1 << SEGMENT_BITS - 3), np.uint8)
    for segment, bits in zip(packed.segment, packed.bits):
        out[segment] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, percent: int = 100,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, cut, a, l, r, n, score: each language's ``top`` phrases of 2 to
    ``max_words`` words that occur ``min_count`` times or more.

    A-Z count as lower case; pieces end at ``.,;:!?`` and line breaks, words at spaces
    and tabs; phrases stay within a piece and overlap freely. a: occurrences of the
    phrase, n: of all words of the language; at the cut after k words with the
    smallest floor(1000 * a * n / (l * r)), the score, l and r count the two sides; ties
    go to the smallest k. A phrase goes if a longer frequent phrase holds it and occurs
    in at least ``percent`` per cent of its places. Null languages are ``und``; null and
    empty texts have no words; rows without id or repeated rows are texts like any
    other; other columns are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                       docs[text_col].alias("text")).where("text IS NOT NULL")
    dictionary = cut(parse(rows, max_words - 1), "phrase-dictionary")
    total = dictionary.groupBy("lang").agg(F.sum(F.col("owned") * F.col("weight")).alias("n"))

    words = cut(count_keys(dictionary, 1, 64).where(F.col("f") >= min_count), "phrase-words")
    known = spark.sparkContext.broadcast(filter_bits(words, 64))
    pairs = count_keys(dictionary, 2, PAIR_BITS, known).where(F.col("f") >= min_count)
    pairs = spark.sparkContext.broadcast(filter_bits(pairs, PAIR_BITS))
    every = cut(count_phrases(dictionary, max_words, pairs).where(F.col("f") >= min_count), "phrase-frequent")
    known.unpersist(), pairs.unpersist()
    long = every.withColumn("ws", F.split("phrase", " ", -1))

    # A longer phrase holds a shorter one often enough only if one with one word more does.
    inner = long.where("m > 2").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice("ws", F.lit(1), F.col("m") - 1), " "), F.array_join(F.slice("ws", 2, F.col("m") - 1), " "))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = long.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * percent)).drop("longer")

    single = left.select("lang", F.explode("ws").alias("part")).distinct()
    side = every.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    side = cut(side.unionByName(word_counts(single, words)), "phrase-parts")
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "m", "ws",
                       F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ")).withColumn(
        "right", F.array_join(F.slice("ws", F.col("k") + 1, F.col("m") - F.col("k")), " ")).drop("ws")
    for name, out in (("left", "l"), ("right", "r")):
        part = side.select("lang", F.col("part").alias(name), F.col("count").alias(out))
        cuts = cuts.join(part, ["lang", name])
    cuts = cuts.join(total, "lang")
    score = F.expr("(1000 * cast(a AS decimal(19,0)) * cast(n AS decimal(19,0))) div "
                   "(cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("w")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(worst).select("lang", "phrase", "a", "n", "w.*")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (scored.withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("k").alias("cut"), "a", "l", "r",
                    "n", "score"))
