"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. The
votes of all documents are counted per pattern (at most 3^labellers rows, few in
practice); expectation-maximisation on these counts estimates each labeller's
accuracy and the share of good documents (Dawid-Skene), which gives every
pattern a posterior. The posteriors of a bounded sample of documents train a
linear scorer on hashed byte n-grams of the whole text; the scorer, which also
ranks documents on which labellers abstain, decides for all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

#: Documents that train the scorer: the expected size of the sample (chosen by a
#: hash of the id) and the most that is ever taken.
SAMPLE = 3000
SAMPLE_MAX = 4000
BINS = 2048
GOOD, BAD, ABSTAIN = 1, 0, 2
#: What the labellers are built for, as pseudo-counts per document: they seldom
#: accuse good documents, and each knows only one kind of junk.
PRIOR = 0.5
EXPECTED = {GOOD: np.array([0.01, 0.99]), BAD: np.array([0.01, 0.02])}

_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _STOP, _MARK, _SHOUT, _BAR, _HIGH = range(10)


def _classes() -> np.ndarray:
    c = np.full(256, _MARK, np.uint8)
    c[ord("A"):ord("Z") + 1] = _UPPER
    c[ord("a"):ord("z") + 1] = _LOWER
    c[ord("0"):ord("9") + 1] = _DIGIT
    c[[9, 11, 12, 13, 32]] = _SPACE
    c[10] = _LINE
    c[list(b".,;:'\"()-?")] = _STOP
    c[ord("!")] = _SHOUT
    c[ord("|")] = _BAR
    c[128:] = _HIGH
    return c


CLASSES = _classes()


def measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(byte classes, ratios) of one text; ratios: marks, shouts, upper case, bars,
    repeats of the word before, words' variety, word length, words."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    cls = CLASSES[b]
    n = np.bincount(cls, minlength=10)
    words = text.split()
    solid = max(1, len(b) - n[_SPACE] - n[_LINE])
    w = max(1, len(words))
    return cls, np.array([n[_MARK] / solid, n[_SHOUT] / solid, n[_UPPER] / max(1, n[_UPPER] + n[_LOWER]), n[_BAR] / w,
                          sum(map(eq, words, words[1:])) / w, len(set(words)) / w, solid / w, len(words)])


def votes(r: np.ndarray) -> tuple[int, ...]:
    """The labellers' votes on a document with the given ratios."""
    marks, shouts, upper, bars, repeats, variety, length, words = r

    def two(x: float, good: float, bad: float) -> int:
        return GOOD if x <= good else BAD if x >= bad else ABSTAIN

    if words == 0:
        return (BAD,) * LABELLERS
    short = words < 12
    return (two(marks, 0.02, 0.10), two(shouts, 0.005, 0.04), two(upper, 0.25, 0.5) if not short else ABSTAIN,
            two(bars, 0.01, 0.08), two(repeats, 0.05, 0.2) if not short else ABSTAIN,
            ABSTAIN if short else BAD if variety < 0.6 / np.sqrt(words / 12) and variety < 0.12 else
            GOOD if variety > 0.25 else ABSTAIN,
            GOOD if 2.5 <= length <= 9 else BAD if length > 14 or length < 1.5 else ABSTAIN,
            BAD if marks + shouts > 0.08 or bars > 0.06 or repeats > (0.5 if short else 0.15) or upper > 0.6 and words > 5
            else ABSTAIN if short else GOOD)


LABELLERS = 8


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good by pattern, P(vote | class) [class, labeller, vote], share of
    good). Whether a labeller abstains tells nothing about the class."""
    m = patterns.shape[1]
    good = (patterns == GOOD).sum(1)
    bad = (patterns == BAD).sum(1)
    # A junk document offends against one rule and satisfies the rest: a bad vote starts heavier.
    p = np.clip((good + 1) / (good + 4 * bad + 2), 0.02, 0.98)
    hot = np.stack([patterns == v for v in (BAD, GOOD)], axis=2).astype(float)
    for _ in range(rounds):
        table = np.empty((2, m, 2))
        for c, weight in ((GOOD, p * counts), (BAD, (1 - p) * counts)):
            t = np.einsum("i,ijv->jv", weight, hot) + 0.5 + prior * counts.sum() * EXPECTED[c]
            table[c] = t / t.sum(1, keepdims=True)
        share = float(np.clip((p * counts).sum() / counts.sum(), 0.01, 0.99))
        logit = np.log(share / (1 - share)) + np.einsum("ijv,jv->i", hot, np.log(table[GOOD] / table[BAD]))
        new = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        if abs(new - p).max() < 1e-6:
            p = new
            break
        p = new
    return p, table, share


def features(text: str) -> np.ndarray:
    """Hashed features of a whole text: class trigrams (1000), hashed byte
    trigrams (BINS), steps of the ratios (64); each group sums to about 1."""
    cls, r = measures(text)
    out = np.zeros(1000 + BINS + 64, np.float32)
    if len(cls) >= 3:
        c = cls.astype(np.int32)
        out[:1000] = np.bincount(c[:-2] * 100 + c[1:-1] * 10 + c[2:], minlength=1000) / (len(c) - 2)
        b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35))
        out[1000:1000 + BINS] = np.bincount((h >> 15) % BINS, minlength=BINS) / (len(b) - 2)
    step = np.clip(np.r_[r[:6] * 16, r[6] / 1.5, np.log2(r[7] + 1)], 0, 7).astype(int)
    out[1000 + BINS + np.arange(8) * 8 + step] = 0.5
    return out


def train(x: np.ndarray, p: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic scorer on posteriors p, both classes weighted alike, by accelerated
    gradient steps: (scale, weights, bias)."""
    scale = (1 / (x.std(0) + 1e-3)).astype(np.float32)
    centre = (x * scale).mean(0)
    z = np.hstack([x * scale - centre, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    weight = np.where(p >= 0.5, 0.5 / max(1e-9, p.sum()), 0.5 / max(1e-9, (1 - p).sum())).astype(np.float32)
    # Step length from the largest curvature, by power iteration.
    v = np.ones(z.shape[1], np.float32)
    for _ in range(20):
        v = z.T @ (weight * (z @ v))
        v /= np.linalg.norm(v) or 1.0
    step = 1 / (0.25 * float(v @ (z.T @ (weight * (z @ v)))) + decay + 1e-9)
    w = ahead = np.zeros(z.shape[1], np.float32)
    for i in range(rounds):
        g = z.T @ (weight * (1 / (1 + np.exp(-np.clip(z @ ahead, -40, 40))) - p)) + decay * ahead
        new = (ahead - step * g).astype(np.float32)
        ahead = (new + i / (i + 3) * (new - w)).astype(np.float32)
        w = new
    return scale, w[:-1], float(w[-1] - centre @ w[:-1])


class Model:
    """Posterior by vote pattern and the linear scorer."""

    def __init__(self, weak: dict[str, float], weights: np.ndarray, bias: float):
        self.weak, self.weights, self.bias = weak, weights, bias

    def score(self, text: str) -> float:
        if not text.strip():
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(features(text) @ self.weights + self.bias, -40, 40))))

    def posterior(self, text: str) -> float:
        return self.weak.get(_pattern(text), 0.5) if text.strip() else 0.0

    def keeps(self, score: float, posterior: float) -> bool:
        """The scorer decides where the labellers are unsure: log-odds add up."""
        odds = [np.log(p / (1 - p)) for p in np.clip([score, posterior], 0.01, 0.99)]
        return score > 0 and sum(odds) >= 0


def _pattern(text: str) -> str:
    return "".join(map(str, votes(measures(text)[1])))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
        sample_max: int = SAMPLE_MAX) -> Model | None:
    """EM over the votes of all documents, then the scorer on a bounded sample; None without documents."""
    rows = texts(docs, id_col, text_col)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches):
            yield pd.DataFrame({"v": list(map(_pattern, pdf.text))})

    counted = rows.mapInPandas(vote, "v string").groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        return None
    counts = np.array([r.n for r in counted], float)
    posterior, _, _ = em(np.array([[int(c) for c in r.v] for r in counted]), counts)
    weak = {r.v: float(p) for r, p in zip(counted, posterior)}
    share = min(1.0, sample / counts.sum())

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches):
            yield pd.DataFrame({"p": [weak.get(_pattern(t), 0.5) for t in pdf.text],
                                "x": [features(t).tobytes() for t in pdf.text]})

    # A hash of id and text picks the sample: the same rows however the table is dealt.
    pick = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < F.lit(int(np.ceil(share * (1 << 40))))
    taken = rows.where(pick).mapInPandas(featurise, "p double, x binary").limit(sample_max).collect()
    if not taken:
        taken = rows.limit(sample).mapInPandas(featurise, "p double, x binary").collect()
    x = np.stack([np.frombuffer(r.x, np.float32) for r in taken])
    scale, w, bias = train(x, np.array([r.p for r in taken], np.float32))
    return Model(weak, scale * w, bias)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
             sample_max: int = SAMPLE_MAX) -> DataFrame:
    """One row per row of ``docs``: doc_id, weak (posterior by the labellers),
    score (scorer's probability of good), kept (the log-odds of both sum to 0 or more).

    Null and empty texts have no words and are rejected (weak and score 0);
    repeated rows are scored each; texts of any length are read whole; a null id
    is scored like others; an empty table gives no rows.
    """
    model = fit(docs, id_col, text_col, sample, sample_max)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches):
            s, w = list(map(model.score, pdf.text)), list(map(model.posterior, pdf.text))
            yield pd.DataFrame({"doc_id": pdf.doc_id.astype("Int64"), "weak": w, "score": s,
                                "kept": list(map(model.keeps, s, w))})

    return texts(docs, id_col, text_col).mapInPandas(score, "doc_id long, weak double, score double, kept boolean")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text the classifier keeps."""
    model = fit(docs, id_col, text_col)
    if model is None:
        return docs

    def choose(batches):
        import pyarrow as pa
        for batch in batches:
            found = [x.as_py() or "" for x in batch.column(text_col)]
            good = [bool(model.keeps(model.score(t), model.posterior(t))) for t in found]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
