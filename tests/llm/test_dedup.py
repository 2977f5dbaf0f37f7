"""Line, exact, near and substring dedup against plain versions."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from notaflow.llm import fm_dedup, jaccard, line_spread, radix_dedup
from tests.llm import brute


def test_exact(docs, corpus, no_docs):
    got = radix_dedup.exact_groups(docs, first_digit=8).collect()
    assert Counter(map(tuple, got)) == brute.exact([r[:2] for r in corpus])
    assert radix_dedup.exact_groups(no_docs).count() == 0


def test_exact_null_ids(spark):
    rows = [(None, "a b"), (7, "ab"), (None, "c"), (9, "a  b")]
    got = radix_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == Counter(
        [(None, 9, 3, False), (7, 9, 3, False), (None, None, 1, True), (9, 9, 3, True)])


@pytest.mark.parametrize("block", [1000, 7])
def test_components(docs, corpus, no_docs, block):
    got = jaccard.similar_components(docs, block=block).collect()
    want = brute.components([r[:2] for r in corpus])
    assert len(got) == len(corpus)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < len(want) - 20
    if block == 7:
        assert jaccard.similar_components(no_docs).count() == 0


def test_components_common_shingles_last(docs, corpus):
    """Any order of the shingles gives the same links."""
    got = jaccard.similar_components(docs, common_share=0.9).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components([r[:2] for r in corpus])


def test_component_without_id(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (4, "A b c d e")]
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter([(None, None), (3, 3), (4, 3)])


def test_stars_join_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (101, 100)], "a long, b long")
    got = {r.node: r.label for r in jaccard.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[100] == got[101] == 99


@pytest.mark.parametrize("crowd", [1000, 2])
def test_repeats(docs, corpus, no_docs, crowd):
    """Both routes, by owner and window by window, give the same."""
    got = fm_dedup.remove_repeats(docs, crowd=crowd, carry=("key", "text")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute.repeats([r[:2] for r in corpus])
    assert all(sum(n for _, n in r.spans) == r.n_removed and r.key == "x" for r in got)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in corpus)  # null stays null
    if crowd == 2:
        assert fm_dedup.remove_repeats(no_docs, carry=("n",)).columns[-1] == "n"


def test_repeats_known_anchors(docs, corpus):
    got = fm_dedup.remove_repeats(docs, common_share=0.0, crowd=20, outputs=False).collect()
    assert Counter(map(tuple, got)) == brute.repeats([r[:2] for r in corpus])


def test_repeats_without_id(spark):
    text = " ".join(map(str, range(20)))
    got = fm_dedup.remove_repeats(spark.createDataFrame([(None, text), (None, text + " x"), (5, "q " + text)],
                                                        "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == Counter([(None, 20), (None, 20), (5, 0)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=4, max_size=40), min_size=1, max_size=8), st.integers(2, 4))
def test_matching_minima(texts, window):
    texts = [np.array(t, np.int64) for t in texts]
    owners = np.arange(len(texts))[::-1]
    got = fm_dedup.matching_minima(texts, owners, 4, window)
    least = {}
    for t, o in zip(texts, owners):
        for i in range(len(t) - window + 1):
            k = tuple(t[i:i + window])
            least[k] = min(least.get(k, o), o)
    for t, m in zip(texts, got):
        assert m.tolist() == [least[tuple(t[i:i + window])] for i in range(len(t) - window + 1)]


def test_rank_counts_bits():
    rng = np.random.default_rng(3)
    for n in (1, 63, 64, 65, 1000):
        bits = rng.integers(0, 2, n)
        b = fm_dedup.Bits(bits)
        assert b.rank1(np.arange(n + 1)).tolist() == [0, *np.cumsum(bits)]


def test_boilerplate(spark, docs, corpus, no_docs):
    for sites in (2, 3):
        got = line_spread.remove_boilerplate(docs, min_sites=sites).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in got) == brute.boilerplate(corpus, sites)
    assert line_spread.remove_boilerplate(no_docs).count() == 0


def test_boilerplate_near_and_far_from_threshold(spark):
    """Lines on 1, 4, 5, 9 and 60 sites; white space around a line does not matter."""
    rows = [(100 * k + i, f"own {k} {i}\n line {k}\t", f"site{i}") for k in (1, 4, 5, 9, 60) for i in range(k)]
    rows += [(9000, "line 5\nline 4", None), (9001, None, "s"), (None, "line 60", "site1")]
    got = line_spread.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in got) == brute.boilerplate(rows, 5)
