"""Masked pseudo-likelihood scoring with a bidirectional window network.

Vocabulary: every word of the corpus. The most frequent have a token each, all
others share hashed buckets, and within its bucket a word has its share of the
bucket's count over the whole corpus. The network sees two tokens on either side of a masked one and predicts
it in two steps, its class and its member given the class:
h = tanh(sum of position embeddings + bias), p = softmax(A h)[class] *
softmax(B h + U[class])[member], times P(word | bucket) for a word in a bucket. It is trained in numpy; a round takes every
``stride``-th position of each document, the rounds together all of them: a task trains on its documents from the
round's common parameters, and the parameters are averaged by tokens, merged
as a tree so that no node receives more than FAN_IN models. The score of a
document is the sum of the log-probabilities of its tokens given their
neighbours. Words in buckets are any number: their counts stay in a table dealt
by word hash, slices of documents ask it for their distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices, texts
from .words import HashedWords

CLASSES, MEMBERS = 32, 32
VOCABULARY = CLASSES * MEMBERS
FREQUENT = VOCABULARY // 2
DIM = 16
CONTEXT = (-2, -1, 1, 2)
PAD = VOCABULARY
ROUNDS = 2
#: As many as rounds: each round takes another shift, so every position trains once.
STRIDE = ROUNDS
BATCH = 4096
RATE = 0.1
FAN_IN = 64
#: Tokens of the corpus to a shard of word counts.
SHARD_TOKENS = 16_000_000

SHAPES = {"E": (len(CONTEXT), VOCABULARY + 1, DIM), "b": (DIM,), "A": (DIM, CLASSES), "a0": (CLASSES,),
          "B": (DIM, MEMBERS), "U": (CLASSES, MEMBERS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = flat[at:at + n].reshape(s)
        at += n
    return out


def start(counts: np.ndarray, seed: int = 7) -> np.ndarray:
    """Small random embeddings; output biases at the unigram distribution ``counts``."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(SIZE, np.float32)
    p = unpack(flat)
    for k in ("E", "A", "B"):
        p[k][...] = rng.normal(0, 0.1, p[k].shape)
    c = counts.reshape(CLASSES, MEMBERS) + 0.5
    p["a0"][...] = np.log(c.sum(1) / c.sum())
    p["U"][...] = np.log(c / c.sum(1, keepdims=True))
    return flat


class Numbered:
    """Token ids of texts: words between white space [\x20\x09-\x0D], A-Z in lower case;
    the frequent ones by rank, all others by a hash."""

    def __init__(self, frequent: np.ndarray):
        order = np.argsort(frequent)
        self.known, self.rank = frequent[order], order

    def number(self, h: np.ndarray) -> np.ndarray:
        out = FREQUENT + (h % np.uint64(VOCABULARY - FREQUENT)).astype(np.int64)
        if len(self.known):
            k = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            hit = self.known[k] == h
            out[hit] = self.rank[k[hit]]
        return out

    def __call__(self, texts_: list[str]) -> list[np.ndarray]:
        h, _, counts = HashedWords(lower=True)(texts_)
        return np.split(self.number(h), np.cumsum(counts)[:-1]) if texts_ else []


def contexts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, neighbours [token, position]) of texts one after another, padded at their ends."""
    pad = np.full(2, PAD, np.int64)
    joined = np.concatenate([x for t in ids for x in (pad, t.astype(np.int64))] + [pad])
    real = np.flatnonzero(joined != PAD)
    return joined[real], np.stack([joined[real + o] for o in CONTEXT], axis=1)


def hidden(p: dict[str, np.ndarray], near: np.ndarray) -> np.ndarray:
    h = p["E"][0][near[:, 0]]
    for j in range(1, near.shape[1]):
        h = h + p["E"][j][near[:, j]]
    return np.tanh(h + p["b"])


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exp(z - max), its row sums); ``z`` is left reduced by the row's largest entry."""
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e, e.sum(axis=1)


def log_probabilities(p: dict[str, np.ndarray], tokens: np.ndarray, near: np.ndarray, chunk: int = 1 << 12) -> np.ndarray:
    out = np.empty(len(tokens))
    for i in range(0, len(tokens), chunk):
        t, h = tokens[i:i + chunk], hidden(p, near[i:i + chunk])
        c, m, r = t // MEMBERS, t % MEMBERS, np.arange(len(t))
        za, zb = h @ p["A"] + p["a0"], h @ p["B"] + p["U"][c]
        sums = _softmax(za)[1] * _softmax(zb)[1]
        out[i:i + chunk] = za[r, c] + zb[r, m] - np.log(sums)
    return out


class Trainer:
    """Adagrad steps on batches of positions."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat.copy()
        self.p = unpack(self.flat)
        self.seen = {k: np.full(v.shape, 0.1, np.float32) for k, v in self.p.items()}
        self.tokens = 0

    def step(self, tokens: np.ndarray, near: np.ndarray) -> None:
        p, n = self.p, len(tokens)
        h = hidden(p, near)
        c, m, r = tokens // MEMBERS, tokens % MEMBERS, np.arange(n)
        (da, sa), (db, sb) = _softmax(h @ p["A"] + p["a0"]), _softmax(h @ p["B"] + p["U"][c])
        da /= sa[:, None]
        db /= sb[:, None]
        da[r, c] -= 1
        db[r, m] -= 1
        dh = (da @ p["A"].T + db @ p["B"].T) * (1 - h * h)
        du, de = np.zeros((n, CLASSES), np.float32), np.zeros_like(p["E"])
        du[r, c] = 1
        du = du.T @ db
        # Rows of one embedding are added up side by side: sorted by (position, token).
        row = (near + np.arange(near.shape[1]) * (VOCABULARY + 1)).ravel().astype(np.uint16)
        order = np.argsort(row, kind="stable")
        row = row[order]
        first = np.flatnonzero(np.diff(row, prepend=row[:1] + 1))
        de.reshape(-1, DIM)[row[first]] = np.add.reduceat(dh[order // near.shape[1]], first, axis=0)
        for k, g in (("A", h.T @ da), ("a0", da.sum(0)), ("B", h.T @ db), ("U", du), ("E", de), ("b", dh.sum(0))):
            g = g / np.float32(n) * np.float32(32)
            self.seen[k] += g * g
            p[k] -= np.float32(RATE) * g / np.sqrt(self.seen[k])
        self.tokens += n


def word_counts(rows: DataFrame) -> DataFrame:
    """(w, n): every word of the corpus; every document is counted, tasks pre-aggregate."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, held, n = HashedWords(lower=True), [], 0
        for pdf in slices(batches, budget=1 << 20):
            held.append(words(pdf.text.tolist())[0])
            n += len(held[-1])
            if n > 4_000_000:
                yield counted_frame(held)
                held, n = [], 0
        yield counted_frame(held)

    def counted_frame(held: list[np.ndarray]) -> pd.DataFrame:
        w, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        return pd.DataFrame({"w": w.astype(np.int64), "n": n})

    return cut(rows.mapInPandas(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "lm-words")


def vocabulary(rows: DataFrame, counted: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the most frequent words, most frequent first; the corpus' token counts
    by id)."""
    counted = word_counts(rows) if counted is None else counted
    top = counted.orderBy(F.desc("n"), "w").limit(FREQUENT).collect()
    frequent = np.array([r.w for r in top], np.int64).astype(np.uint64)

    def bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, number = np.zeros(VOCABULARY, np.int64), Numbered(frequent)
        for pdf in batches:
            np.add.at(out, number.number(pdf.w.to_numpy(np.int64).astype(np.uint64)), pdf.n.to_numpy())
        yield pd.DataFrame({"i": np.arange(VOCABULARY), "n": out})

    ids = counted.mapInPandas(bucket, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(VOCABULARY)
    for r in ids:
        counts[r.i] = r.n
    return frequent, counts


def mean_model(tokens: list[int], flats: list[bytes]) -> tuple[int, np.ndarray]:
    """(all tokens, mean of the parameters weighted by tokens)."""
    total = sum(tokens)
    return total, sum((np.frombuffer(f, np.float32) * np.float64(t / total) for t, f in zip(tokens, flats)), np.zeros(SIZE))


def _merge(models: DataFrame) -> np.ndarray | None:
    """Mean model of all tasks, merged FAN_IN at a time; None without any."""
    models = cut(models, "lm-models")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total, flat = mean_model(pdf.tokens.tolist(), pdf.flat.tolist())
        return pd.DataFrame({"k": [int(pdf.k.iloc[0]) // FAN_IN], "tokens": [total], "flat": [flat.astype(np.float32).tobytes()]})

    while models.count() > FAN_IN:
        models = cut(models.groupBy((F.col("k") / FAN_IN).cast("long").alias("g")).applyInPandas(
            merge, "k long, tokens long, flat binary"), "lm-models")
    rows = models.collect()
    return mean_model([r.tokens for r in rows], [r.flat for r in rows])[1].astype(np.float32) if rows else None


def positions(lens: list[int], shift: int, stride: int) -> np.ndarray:
    """Places, in the joined tokens, of every ``stride``-th token of each text from ``shift`` on."""
    first = np.cumsum([0, *lens])[:-1]
    within = np.arange(sum(lens)) - np.repeat(first, lens)
    return np.flatnonzero(within % stride == shift % stride)


def _texts_of(tokens: bytes, lens: bytes) -> list[np.ndarray]:
    """The documents of a numbered slice."""
    ids, n = np.frombuffer(tokens, np.uint16), np.frombuffer(lens, np.int64)
    return np.split(ids, np.cumsum(n)[:-1]) if len(n) else []


def train(rows: DataFrame, frequent: np.ndarray, flat: np.ndarray, rounds: int, stride: int) -> np.ndarray:
    return train_numbered(number_words(rows, frequent, 1).where("shard < 0"), flat, rounds, stride)


def train_numbered(numbered: DataFrame, flat: np.ndarray, rounds: int, stride: int) -> np.ndarray:
    """The model after ``rounds`` over numbered slices (tokens, lens)."""
    for r in range(rounds):
        def learn(batches: Iterator[pd.DataFrame], base=flat, shift=r) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext
            model = Trainer(base)
            for pdf in batches:
                for t, n in zip(pdf.tokens, pdf.lens):
                    ids = _texts_of(t, n)
                    tokens, near = contexts(ids)
                    pick = positions([len(x) for x in ids], shift, stride)
                    for i in range(0, len(pick), BATCH):
                        part = pick[i:i + BATCH]
                        model.step(tokens[part], near[part])
            if model.tokens:
                yield pd.DataFrame({"k": [TaskContext.get().partitionId()], "tokens": [model.tokens],
                                    "flat": [model.flat.tobytes()]})

        merged = _merge(numbered.select("tokens", "lens").mapInPandas(learn, "k long, tokens long, flat binary"))
        flat = flat if merged is None else merged
    return flat


def number_words(rows: DataFrame, frequent: np.ndarray, shards: int) -> DataFrame:
    """The texts as numbers, written once for all rounds and the scoring: a row for each
    slice (shard -1: token ids of 16 bits, documents, places of the words in buckets)
    and one for each shard of word counts that the slice asks (``words``: hashes)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        number, words = Numbered(frequent), HashedWords(lower=True)
        name = TaskContext.get().partitionId() << 32
        for pdf in slices(batches, budget=1 << 20):
            h, _, lens = words(pdf.text.tolist())
            tokens = number.number(h)
            rare = tokens >= FREQUENT
            doc = np.repeat(np.arange(len(lens)), lens)
            distinct, at = np.unique(h[rare], return_inverse=True)
            ends = np.searchsorted(shard_of(distinct, shards), np.arange(shards + 1))
            asked = [(name, k, distinct[a:b].tobytes()) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if a < b]
            null = pdf.doc_id.isna().to_numpy(bool)
            home = (name, -1, at.astype(np.int32).tobytes(), pdf.doc_id.fillna(0).to_numpy(np.int64).tobytes(), null.tobytes(),
                    lens.astype(np.int64).tobytes(), np.bincount(doc[rare], minlength=len(lens)).astype(np.int64).tobytes(),
                    tokens.astype(np.uint16).tobytes())
            yield pd.DataFrame([home, *[(*x, *[None] * 5) for x in asked]],
                               columns=["slice", "shard", "words", "ids", "null", "lens", "rare", "tokens"])
            name += 1

    return cut(rows.mapInPandas(run, "slice long, shard int, words binary, ids binary, null binary, lens binary, "
                                     "rare binary, tokens binary"), "lm-numbered")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
          stride: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, log_prob (sum over all tokens
    of the whole text, 0 without words), mean_log_prob (null without words).

    Null texts are empty; repeated rows train and score each; a null id is kept;
    an empty table gives no rows; other columns are ignored. ``stride``: default
    ``rounds``, so that every position trains once.
    """
    rows = texts(docs, id_col, text_col)
    stride = max(1, rounds) if stride is None else stride
    counted = word_counts(rows)
    frequent, counts = vocabulary(rows, counted)
    shards = max(16, int(counts.sum()) // SHARD_TOKENS)
    asked = number_words(rows, frequent, shards)
    numbered = asked.where("shard < 0").drop("shard")
    flat = train_numbered(numbered, start(counts), rounds, stride)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each slice with the sums of its documents, scored up to their buckets."""
        p, share = unpack(flat), np.log(np.maximum(counts, 1))
        share[:FREQUENT] = 0
        for pdf in batches:
            total = []
            for t, n in zip(pdf.tokens, pdf.lens):
                ids, lens = _texts_of(t, n), np.frombuffer(n, np.int64)
                tokens, near = contexts(ids)
                each = log_probabilities(p, tokens, near) - share[tokens]
                total.append(np.bincount(np.repeat(np.arange(len(lens)), lens), weights=each, minlength=len(lens)).tobytes())
            yield pdf.drop(columns="tokens").assign(total=total)

    scored = numbered.mapInPandas(run, "slice long, words binary, ids binary, null binary, lens binary, rare binary, "
                                       "total binary")
    shard = F.shiftright(F.shiftrightunsigned("w", 32) * F.lit(shards).cast("long"), 32).cast("int")
    replies = (counted.withColumn("shard", shard).groupBy("shard")
               .cogroup(asked.where("shard >= 0").select("slice", "shard", "words").groupBy("shard"))
               .applyInPandas(reply, "slice long, shard int, logs binary"))
    return (scored.groupBy("slice").cogroup(replies.groupBy("slice"))
            .applyInPandas(add_up, "doc_id long, n_tokens long, log_prob double, mean_log_prob double"))


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Ascending with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def reply(counted: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Log counts of the words each slice asks for, in its order."""
    w, n = counted.w.to_numpy(np.int64).astype(np.uint64), counted.n.to_numpy(np.int64)
    order = np.argsort(w)
    w, log = w[order], np.log(n[order])
    logs = [log[np.searchsorted(w, np.frombuffer(x, np.uint64))].tobytes() for x in asked.words]
    return pd.DataFrame({"slice": asked["slice"], "shard": asked["shard"], "logs": logs})


def add_up(home: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    """The slice's documents with log P(word | bucket) of their words in buckets."""
    log = np.frombuffer(b"".join(replies.sort_values("shard").logs), np.float64)
    x = home.iloc[0]
    lens, rare = np.frombuffer(x.lens, np.int64), np.frombuffer(x.rare, np.int64)
    total = np.frombuffer(x.total, np.float64) + np.bincount(
        np.repeat(np.arange(len(rare)), rare), weights=log[np.frombuffer(x.words, np.int32)], minlength=len(rare))
    ids = pd.Series(np.frombuffer(x.ids, np.int64)).astype("Int64").mask(np.frombuffer(x["null"], bool))
    return pd.DataFrame({"doc_id": ids, "n_tokens": lens, "log_prob": total,
                         "mean_log_prob": [t / n if n else None for t, n in zip(total, lens)]})
