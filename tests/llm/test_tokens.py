"""Tokenisation and packing against the libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from notaflow.llm import packing, pieces

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TOK = Tokenizer.from_file(WORDS)
TEXT = st.text(alphabet=st.one_of(st.sampled_from("ab the\n\t ▁é̈日🎉\x00'.,%<|>ſİ"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_pieces_like_library(text):
    m = pieces.model(PIECES)
    ids = m.encode([text])[0]
    assert ids.tolist() == SP.encode(text, add_bos=True, add_eos=True)
    assert m.decode(ids) == SP.decode(ids.tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=20))
def test_decode_any_ids(ids):
    assert pieces.model(PIECES).decode(np.array(ids, np.int64)) == SP.decode(ids)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "ab" * 3000, "\n" * 99, "▁" * 7, ""])
def test_pieces_long_runs(text):
    assert pieces.model(PIECES).encode([text])[0].tolist() == SP.encode(text, add_bos=True, add_eos=True)


def test_encode_decode(docs, corpus, no_docs):
    got = pieces.encode_decode(docs, PIECES).collect()
    assert len(got) == len(corpus)
    text = {d: t or "" for d, t, _ in corpus}
    for r in got:
        want = SP.encode(text[r.doc_id], add_bos=True, add_eos=True)
        assert r.ids == want and r.n_tokens == len(want) and r.decoded == SP.decode(want)
    assert pieces.encode_decode(no_docs, PIECES).count() == 0


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_words_like_library(text):
    ids = packing.encoder(WORDS)([text])[0]
    assert ids.tolist() == TOK.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("totals,weights", [([50_000, 3000, 20, 0], None), ([9000, 9000, 500], [1.0, 2.0, 1.0]),
                                            ([9000, 9000, 500], [1.0, 2.0, 0.0]), ([5], None), ([1] * 32, None),
                                            ([10_000] * 32, None)])
def test_layout(totals, weights):
    """Queues are served in order and completely, windows are full, shares near the target."""
    lay = packing.Layout(totals, weights)
    before = lay.served(0)
    for t in range(packing.WINDOW, sum(totals) + packing.WINDOW, packing.WINDOW):
        after = lay.served(t)
        assert all(a <= b for a, b in zip(before, after)) and sum(after) == min(t, sum(totals))
        if weights is None:
            assert all(abs(b - n * sum(after) / sum(totals)) < len(totals) + 1 for b, n in zip(after, totals))
        before = after
    assert list(before) == totals


def check(rows, got):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    times = defaultdict(int)
    for d, t, _ in rows:
        times[d] += 1
    text = {d: t or "" for d, t, _ in rows}
    assert set(by_doc) == set(text)
    for d, ps in by_doc.items():
        ids = TOK.encode(text[d], add_special_tokens=False).ids + [1]
        assert sum(p.length for p in ps) == times[d] * len(ids)
        if times[d] == 1:
            ps.sort(key=lambda p: p.start)
            assert [p.start for p in ps] == [sum(p.length for p in ps[:i]) for i in range(len(ps))]
        for p in ps:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    full = 0
    for ps in by_window.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(p.length for p in ps[:i]) for i in range(len(ps))]
        full += sum(p.length for p in ps) == packing.WINDOW
    assert full >= len(by_window) - 1 and sorted(by_window) == list(range(len(by_window)))
    return by_window


def test_pack(docs, corpus, no_docs):
    check(corpus, packing.pack(docs, WORDS).collect())
    assert packing.pack(no_docs, WORDS).count() == 0


def test_pack_targets(docs, corpus):
    """While both sources last, they fill windows in the proportions asked for."""
    windows = check(corpus, packing.pack(docs, WORDS, weights={"s0": 1.0, "s1": 1.0}).collect())
    first = defaultdict(int)
    for p in windows[0]:
        first[p.source] += p.length
    assert abs(first["s0"] - 1024) <= 2 and abs(first["s1"] - 1024) <= 2


def test_pack_many_sources(spark):
    rng = random.Random(3)
    rows = [(i, "word " * rng.randint(1, 80), None if i % 50 == 0 else f"src{i % 47}") for i in range(300)]
    check(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), WORDS).collect())


@pytest.mark.parametrize("weights", [None, [1.0] * 100])
def test_layout_of_many_sources(weights):
    """Each of 100 sources holds its target in every window to a few tokens."""
    totals = [300_000 // (i + 1) + 40_000 for i in range(100)] if weights is None else [40_960] * 100
    lay = packing.Layout(totals, weights)
    for t in range(0, sum(totals), packing.WINDOW):
        got = lay.served(t)
        assert sum(got) == t and all(abs(a - n * t / sum(totals)) < 9 for a, n in zip(got, totals))


def test_pack_small_weighted_source(spark):
    """The smallest of 100 sources has a weight: it is served its share from the first window on."""
    rows = [(i, "word " * (60 if i % 100 else 30), f"src{i % 100:02}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    windows = check(rows, packing.pack(df, WORDS, weights={"src00": 1.0, "src07": 3.0}).collect())
    first = defaultdict(int)
    for p in windows[0]:
        first[p.source] += p.length
    assert set(first) == {"src00", "src07"} and abs(first["src00"] - 512) <= 2
