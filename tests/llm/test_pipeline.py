"""The pipeline's stages against plain versions of what they do."""

import hashlib
from collections import defaultdict

import corpus_pipeline
import __spark_entry__ as E
from notaflow.llm.common import cut, table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, columns, before = table(spark, SF, "documents"), None, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        columns = columns or docs.columns
        docs = cut(stage(spark, docs, SF), f"test-{name}")
        after = docs.collect()
        pairs = [(d, r.text) for d, r in before.items()]
        if name != "packing":
            assert docs.columns == columns
            now = {r.doc_id: r for r in after}
            assert len(now) == len(after)
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            assert all(d in now for d, q in labels.items() if q == 1)
            assert sum(d in now for d, q in labels.items() if q == 0) <= 1
        elif name == "exact_dedup":
            assert set(now) == {k[0] for k in brute.exact(pairs) if k[3]}
        elif name == "near_dedup":
            assert set(now) == {d for d, (_, c) in brute.components(pairs).items() if c == d}
        elif name == "substring_dedup":
            for (d, _, gone, sha), _ in brute.repeats(pairs).items():
                text = now[d].text
                assert text == before[d].text if gone == 0 else hashlib.sha256(text.encode()).hexdigest() == sha
                assert now[d].n_chars == len(text) and now[d].source == before[d].source
        if name in ("quality_classifier", "exact_dedup", "near_dedup"):
            assert all(now[d] == before[d] for d in now)
        if name == "packing":
            tokens = defaultdict(int)
            for r in after:
                tokens[r.doc_id] += r.length
                assert tokens[r.doc_id] <= r.doc_tokens
            assert set(tokens) == set(before)


def test_exact_stage_with_repeated_rows(spark):
    rows = [(1, "a b", "en", "s", 3)] * 2 + [(None, "x", "en", "s", 1)] * 2 + [(2, "ab", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.exact_stage(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "x"), (1, "a b")]


def test_near_stage_between_thresholds(spark):
    """Five-word shingles and 80 %: copies that four words and 85 % would keep apart go."""
    w = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:90], *[f"x{i}" for i in range(10)]])),
            (3, " ".join([*w[:80], *[f"y{i}" for i in range(20)]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {c for _, c in brute.components(rows).values()} == {1, 2, 3}
    want = {d for d, (_, c) in brute.components(rows, n=5, percent=80).items() if c == d}
    assert want == {1, 3}
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, SF).collect()} == want


def test_substring_stage_with_further_columns(spark):
    """Columns that the operator does not know, and such that have its outputs' names, stay."""
    w = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(w), 30, "a", 7), (2, " ".join(["own", *w]), 31, "b", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, extra string, n_words int")
    out = corpus_pipeline.substring_stage(spark, docs, SF)
    assert out.columns == docs.columns and out.schema["n_words"].dataType == docs.schema["n_words"].dataType
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], (2, "own", 3, "b", 8)]


def test_no_documents(spark):
    docs = table(spark, SF, "documents").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_registered():
    names = E.queries()
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
