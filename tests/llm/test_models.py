"""Quality classifier and pseudo-likelihood scoring: held-out accuracy and plain versions."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notaflow.llm import pseudo_lm, quality
from notaflow.llm.common import table, texts
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_em_finds_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = quality.ABSTAIN
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p, accuracy, share = quality.em(patterns, counts.astype(float), prior=0)
    assert abs(share - 0.8) < 0.05
    assert np.allclose(accuracy[quality.GOOD, :, quality.GOOD], right, atol=0.06)
    assert ((p[inverse.ravel()] > 0.5) == truth).mean() > 0.93


def test_quality_held_out(spark):
    """No label trains the classifier: all labelled rows are held out."""
    got = quality.classify(table(spark, SF, "documents")).join(table(spark, SF, "labels"), "doc_id")
    r = got.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {x.quality: x.kept for x in r}
    assert kept[1] > 0.99 and kept[0] < 0.06


def test_quality_edges(spark, docs, corpus, no_docs):
    got = quality.classify(docs).collect()
    assert len(got) == len(corpus)
    assert all(not r.kept and r.score == 0 for r in got if r.doc_id in (130, 131, 132))
    assert quality.classify(no_docs).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert quality.keep_good(no_docs).count() == 0


def test_log_probabilities_loop():
    """The vectorised score is the loop over tokens, and sums to one over the vocabulary."""
    rng = np.random.default_rng(1)
    p = pseudo_lm.unpack(pseudo_lm.start(rng.random(pseudo_lm.VOCABULARY)))
    ids = [rng.integers(0, pseudo_lm.VOCABULARY, n) for n in (5, 1, 0, 9)]
    got = pseudo_lm.log_probabilities(p, *pseudo_lm.contexts(ids))
    want = []
    for t in ids:
        for i in range(len(t)):
            near = [t[i + o] if 0 <= i + o < len(t) else pseudo_lm.PAD for o in pseudo_lm.CONTEXT]
            h = np.tanh(sum(p["E"][j][x] for j, x in enumerate(near)) + p["b"])
            a, b = h @ p["A"] + p["a0"], h @ p["B"] + p["U"]
            each = (a - np.log(np.exp(a).sum()))[:, None] + b - np.log(np.exp(b).sum(1, keepdims=True))
            assert abs(np.exp(each).sum() - 1) < 1e-4
            want.append(each.ravel()[t[i]])
    assert np.allclose(got, want, atol=1e-4)


def test_gradient_by_differences():
    rng = np.random.default_rng(2)
    flat = pseudo_lm.start(np.ones(pseudo_lm.VOCABULARY))
    tokens, near = pseudo_lm.contexts([rng.integers(0, pseudo_lm.VOCABULARY, 400)])
    before = pseudo_lm.log_probabilities(pseudo_lm.unpack(flat), tokens, near).mean()
    t = pseudo_lm.Trainer(flat)
    for _ in range(20):
        t.step(tokens, near)
    assert pseudo_lm.log_probabilities(t.p, tokens, near).mean() > before + 0.5


def test_step_follows_the_gradient():
    """The first step's direction is that of differences of the likelihood, for every kind of parameter."""
    rng = np.random.default_rng(3)
    flat = pseudo_lm.start(rng.random(pseudo_lm.VOCABULARY)).astype(np.float32)
    tokens, near = pseudo_lm.contexts([rng.integers(0, 40, 300) * 25, rng.integers(0, 40, 9) * 25])
    t = pseudo_lm.Trainer(flat)
    t.step(tokens, near)
    moved, at = t.flat - flat, 0
    for name, shape in pseudo_lm.SHAPES.items():
        n = int(np.prod(shape))
        for i in at + np.argsort(-abs(moved[at:at + n]))[:4]:
            up, down = flat.astype(np.float64), flat.astype(np.float64)
            up[i] += 1e-4
            down[i] -= 1e-4
            slope = (pseudo_lm.log_probabilities(pseudo_lm.unpack(up), tokens, near).sum()
                     - pseudo_lm.log_probabilities(pseudo_lm.unpack(down), tokens, near).sum()) / 2e-4
            g = slope / len(tokens) * 32  # Adagrad: the step of one gradient from a sum of squares of 0.1
            assert abs(moved[i] - pseudo_lm.RATE * g / np.sqrt(0.1 + g * g)) < 2e-3, (name, i)
        at += n


def test_training_beats_unigram(spark):
    """Trained on even documents, the network predicts odd ones better than frequencies do."""
    rows = table(spark, SF, "documents").select("doc_id", "text")
    train, held = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")
    frequent, counts = pseudo_lm.vocabulary(train)
    flat = pseudo_lm.train(train, frequent, pseudo_lm.start(counts), 2, 2)
    number = pseudo_lm.Numbered(frequent)
    tokens, near = pseudo_lm.contexts(number([r.text for r in held.collect()]))
    unigram = np.log((counts + 0.5) / (counts + 0.5).sum())[tokens].mean()
    assert pseudo_lm.log_probabilities(pseudo_lm.unpack(flat), tokens, near).mean() > unigram + 0.02


def test_every_position_trains():
    """With the production rounds and stride, also in texts of a few words."""
    lens = [1, 0, 2, 3, 7, 1, 50]
    seen = [i for r in range(pseudo_lm.ROUNDS) for i in pseudo_lm.positions(lens, r, pseudo_lm.STRIDE).tolist()]
    assert sorted(seen) == list(range(sum(lens)))


def test_production_training_beats_unigram(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text")
    train, held = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")
    frequent, counts = pseudo_lm.vocabulary(train)
    flat = pseudo_lm.train(train, frequent, pseudo_lm.start(counts), pseudo_lm.ROUNDS, pseudo_lm.STRIDE)
    tokens, near = pseudo_lm.contexts(pseudo_lm.Numbered(frequent)([r.text for r in held.collect()]))
    unigram = np.log((counts + 0.5) / (counts + 0.5).sum())[tokens].mean()
    assert pseudo_lm.log_probabilities(pseudo_lm.unpack(flat), tokens, near).mean() > unigram + 0.02


def test_score_edges(docs, corpus, no_docs):
    got = pseudo_lm.score(docs, rounds=1).collect()
    assert len(got) == len(corpus)
    by = {r.doc_id: r for r in got}
    assert by[131].n_tokens == 0 and by[131].log_prob == 0 and by[131].mean_log_prob is None
    assert by[135].n_tokens == 20_000 and by[135].log_prob < 0
    assert all(abs(r.mean_log_prob * r.n_tokens - r.log_prob) < 1e-6 * -r.log_prob for r in got if r.n_tokens)
    assert pseudo_lm.score(no_docs, rounds=1).count() == 0


def test_score_is_of_the_word(docs, corpus):
    """Every token counts with its own word: log P(word | bucket) is added for words in
    buckets (untrained network, plain loop)."""
    ws = {d: brute.split(brute.lower(t)) for d, t, _ in corpus}
    n = Counter(w for d, t, _ in corpus for w in ws[d])
    assert len(n) > 2 * pseudo_lm.FREQUENT
    frequent, counts = pseudo_lm.vocabulary(texts(docs))
    p, number = pseudo_lm.unpack(pseudo_lm.start(counts)), pseudo_lm.Numbered(frequent)
    inside = 0
    for r in pseudo_lm.score(docs, rounds=0).collect():
        ids = number([" ".join(ws[r.doc_id])])
        want = pseudo_lm.log_probabilities(p, *pseudo_lm.contexts(ids)).sum()
        for w, i in zip(ws[r.doc_id], ids[0]):
            if i >= pseudo_lm.FREQUENT:
                want += np.log(n[w] / counts[i])
                inside += counts[i] > n[w]
        assert abs(r.log_prob - want) < 1e-6 * max(1, -want)
    assert inside


def test_models_merge_as_tree(spark, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "FAN_IN", 3)
    rng = np.random.default_rng(4)
    flats = [rng.random(pseudo_lm.SIZE).astype(np.float32) for _ in range(8)]
    df = spark.createDataFrame([(i, i + 1, f.tobytes()) for i, f in enumerate(flats)], "k long, tokens long, flat binary")
    want = sum(f * (i + 1) for i, f in enumerate(flats)) / 36
    assert np.allclose(pseudo_lm._merge(df), want, atol=1e-5)
    assert pseudo_lm._merge(df.where("k < 0")) is None


@pytest.mark.parametrize("text,expected", [("", 0), ("word " * 300, 0), ("AAA BBB!! " * 40, 0), ("a | b | c | " * 30, 0)])
def test_votes_reject_junk(text, expected):
    assert (np.array(quality.votes(quality.measures(text)[1])) == quality.BAD).any()
