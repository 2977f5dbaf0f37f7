"""Hard-negative mining with a vertical scan (branch and bound on decomposed vectors).

Vectors lie in shards column by column. For an anchor the dimensions are read in
descending order of its own magnitude; a candidate's score lies between its partial
score plus the least, and plus the most, that the dimensions not read yet can give in
the shard. Candidates whose range can't matter any more leave the bitmap, until the
last dimension gives exact scores for those that stay.

Two scans: the first finds each anchor's positives (the best of its own label), whose
scores define windows; the second finds the best rows of other labels within each
window. Every shard meets every block of anchors (a stated query set), each pair on
its own; only the k best of a pair and window leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARD_ROWS, ANCHOR_BLOCK = 8192, 256
#: Dimensions read between two looks at the bounds.
STEP = 8
SCALE = 256.0
#: Rows found that a task merges at once.
_HELD = 500_000


def vertical_scan(columns: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, alive: np.ndarray,
                  matters: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the candidates of the bitmap ``alive`` that ``matters``
    (least, most possible scores -> bitmap) never gave up."""
    order = np.argsort(-abs(anchor).astype(float), kind="stable")
    ends = anchor * low, anchor * high
    least = np.append(np.cumsum(np.minimum(*ends)[order][::-1])[::-1], 0)  # what order[i:] gives at least
    most = np.append(np.cumsum(np.maximum(*ends)[order][::-1])[::-1], 0)
    rows = np.flatnonzero(alive)
    score = np.zeros(len(rows), columns.dtype)
    for at in range(0, len(order), STEP):
        if not len(rows):
            break
        read = order[at:at + STEP]
        score = score + anchor[read] @ columns[np.ix_(read, rows)]
        to = at + len(read)
        keep = matters(score + least[to], score + most[to])
        rows, score = rows[keep], score[keep]
    return rows, score


def _kth(values: np.ndarray, k: int):
    """The k-th largest, None if there are fewer."""
    return np.sort(values)[-k] if len(values) >= k else None


def best(k: int) -> Callable:
    """Keeps what can be among the k best."""

    def matters(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        floor = _kth(least, k)
        return np.ones(len(least), bool) if floor is None else (most >= floor).astype(bool)

    return matters


def best_within(bounds: list[tuple[int, int]], k: int) -> Callable:
    """Keeps what can be among the k best of a window (from, to)."""

    def matters(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(least), bool)
        for a, b in bounds:
            can = ((most >= a) & (least <= b)).astype(bool)
            floor = _kth(least[((least >= a) & (most <= b)).astype(bool)], k)  # of those surely inside
            keep |= can if floor is None else can & (most >= floor).astype(bool)
        return keep

    return matters


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    if score.dtype == object:
        return sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k]
    return np.lexsort((ids, -score))[:k].tolist()


def _pack(rows: DataFrame, size: int, key: str, extra: str = "") -> tuple[DataFrame, int]:
    """Rows dealt evenly into blocks of about ``size``: (key, n, dims, ids, labels,
    matrix column by column, extra columns as lists); several blocks may share a key."""
    count = max(1, -(-rows.count() // size))
    names = [c.split()[0] for c in extra.split(", ")] if extra else []

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [pdf for pdf in batches if len(pdf)]  # one block
        if held:
            pdf = pd.concat(held)
            dims = max(map(len, pdf.v))
            m = np.zeros((dims, len(pdf)))
            for i, v in enumerate(pdf.v):  # shorter vectors: 0 in what they lack
                m[:len(v), i] = v
            m = np.floor(m * SCALE)
            yield pd.DataFrame({"n": [len(pdf)], "dims": [dims], "ids": [pdf.id.to_numpy("int64").tobytes()],
                                "labels": [pdf.label.to_numpy("int64").tobytes()], "matrix": [m.tobytes()]}
                               | {c: [list(pdf[c])] for c in names})

    fields = "n int, dims int, ids binary, labels binary, matrix binary" + (f", {extra}" if extra else "")
    packed = rows.repartition(count, "id").mapInPandas(build, fields)
    return packed.select((F.shiftright(F.monotonically_increasing_id(), 33) % count).cast("int").alias(key), "*"), count


def _pairs(shards: tuple[DataFrame, int], blocks: tuple[DataFrame, int]) -> DataFrame:
    """Every shard with every block of anchors, dealt pair by pair."""
    (left, n), (right, m) = shards, blocks
    right = right.select("b", *[F.col(c).alias(f"q_{c}") for c in right.columns if c != "b"])
    left = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    tasks = min(n * m, 10_000)  # little data, much work: not to be coalesced
    keys = ["shard", "b"]
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)


def _arrays(n: int, dims: int, ids: bytes, labels: bytes, matrix: bytes):
    return (np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
            np.frombuffer(matrix, np.float64).reshape(dims, n))


def _scan(pairs: DataFrame, k: int, percents: tuple[int, int] | None = None) -> DataFrame:
    """The k best of each anchor: rows of its label (p is 0) or, with ``percents``, rows of
    other labels within these of its p-th positive's score."""

    def best_of(held: list[pd.DataFrame]) -> pd.DataFrame:
        found = pd.concat(held).sort_values(["score", "id"], ascending=[False, True])
        return found.groupby(["anchor_id", "p"], sort=False).head(k)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for found in each(batches):  # what one task finds leaves it merged
            held.append(found)
            size += len(found)
            if size > _HELD:
                held = [best_of(held)]
                size = len(held[0])
                if size > _HELD // 2:
                    yield held.pop()
                    size = 0
        if held:
            yield best_of(held)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                ids, labels, columns = _arrays(r.n, r.dims, r.ids, r.labels, r.matrix)
                q_ids, q_labels, anchors = _arrays(r.q_n, r.q_dims, r.q_ids, r.q_labels, r.q_matrix)
                wide = max(r.dims, r.q_dims)
                columns, anchors = (np.pad(x, ((0, wide - len(x)), (0, 0))) for x in (columns, anchors))
                if float(abs(columns).max(initial=0)) * float(abs(anchors).max(initial=0)) * max(wide, 1) >= 2**53:
                    columns, anchors = (np.array([[int(y) for y in x] for x in m], object).reshape(m.shape)
                                        for m in (columns, anchors))  # exact beyond doubles too
                low, high = columns.min(axis=1), columns.max(axis=1)
                out = []
                for j, (qid, label) in enumerate(zip(q_ids.tolist(), q_labels.tolist())):
                    if percents:
                        bounds = [(-(-percents[0] * int(s) // 100), percents[1] * int(s) // 100) for s in r.q_scores[j]]
                        rows, score = vertical_scan(columns, low, high, anchors[:, j], labels != label,
                                                    best_within(bounds, k))
                        for p, (a, b) in enumerate(bounds):
                            inside = np.flatnonzero(((score >= a) & (score <= b)).astype(bool))
                            top = inside[_top(score[inside], ids[rows[inside]], k)]
                            out += [(qid, p + 1, i, s) for i, s in zip(ids[rows[top]].tolist(), score[top])]
                    else:
                        rows, score = vertical_scan(columns, low, high, anchors[:, j],
                                                    (labels == label) & (ids != qid), best(k))
                        top = _top(score, ids[rows], k)
                        out += [(qid, 0, i, s) for i, s in zip(ids[rows[top]].tolist(), score[top])]
                yield pd.DataFrame([(q, p, i, min(max(int(s), -2**63), 2**63 - 1)) for q, p, i, s in out],
                                   columns=["anchor_id", "p", "id", "score"])

    found = pairs.mapInPandas(search, "anchor_id long, p int, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "p").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column | str, positives: int = 5, negatives: int = 10,
                   low_percent: int = 30, high_percent: int = 90, id_col: str = "vec_id",
                   vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for
    each anchor (rows where ``is_anchor``, over columns id and label) and each of its
    ``positives`` best other rows of the same label, the ``negatives`` best rows of
    other labels whose score is at least ``low_percent`` and at most ``high_percent``
    per cent of the positive's (all, if there are fewer).

    A score is the integer inner product of floor(256 * x); ties go to the smaller
    id. Rows with a null id or label, or a null vector or one holding null or
    non-finite components, take no part; shorter vectors count as 0 in the dimensions
    they lack; scores beyond 64 bits are clipped. Anchors of one id: the smallest row
    is asked. Repeated rows are candidates each, a repeated positive has a window
    each. Anchors without positives, and empty tables, give no rows.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = (vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("long").alias("label"),
                           vectors[vec_col].cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite))
    asked = (rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("m"))
             .select("id", "m.label", "m.v"))
    rows, asked = cut(rows, "bond-rows"), cut(asked, "bond-anchors")
    shards, count = _pack(rows, SHARD_ROWS, "shard")
    shards = cut(shards, "bond-shards"), count
    near = cut(_scan(_pairs(shards, _pack(asked, ANCHOR_BLOCK, "b")), positives), "bond-positives")

    scores = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))
    windowed = asked.join(scores, asked["id"] == scores["anchor_id"]).select("id", "label", "v", F.col("s.score").alias("scores"))
    far = _scan(_pairs(shards, _pack(windowed, ANCHOR_BLOCK, "b", "scores array<array<long>>")), negatives,
                (low_percent, high_percent))
    far = far.select("anchor_id", "p", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("anchor_id", F.col("rank").alias("p"), F.col("id").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    return far.join(near, ["anchor_id", "p"]).select("anchor_id", "positive_id", "rank", "negative_id",
                                                     "positive_score", "negative_score")
