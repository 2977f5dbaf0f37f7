"""Exact top-k inner-product search with MaxScore over shards of postings.

A query is a bag of terms, one per dimension; the posting list of a term holds
the shard's component values, and its contribution to a score is shifted by its
least value in the shard, so contributions are >= 0 and bounded by the term's
span. Terms are ordered by span. The non-essential ones are the largest set of
small terms whose spans together cannot lift a vector over the k-th best score;
the essential postings are traversed for all vectors of the shard, the others
are probed, largest first, only for vectors that are still competitive. Shards
and blocks of queries meet as pairs of matrices; each pair gives its k best per
query, and a window per query merges the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16384
QUERY_BLOCK = 1024
PROBE_TERMS = 8
SCALE = 256.0


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): rows whose vector is not null and has only finite components."""
    v = F.col("v")
    return (vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].cast("array<double>").alias("v"))
            .where(v.isNotNull() & F.col("id").isNotNull()
                   & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))))


def _blocks(rows: DataFrame, size: int, key: str) -> tuple[DataFrame, int]:
    """Rows dealt evenly into blocks: (key, n, dims, ids, matrix), the matrix row by
    row; the key is below the returned count (several blocks may share it)."""
    count = max(1, -(-rows.count() // size))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [pdf for pdf in batches if len(pdf)]  # one block: about ``size`` rows
        if held:
            pdf = pd.concat(held)
            dims = max(map(len, pdf.v))
            m = np.zeros((len(pdf), dims))
            for i, v in enumerate(pdf.v):  # shorter vectors: 0 in what they lack
                m[i, :len(v)] = v
            m = np.floor(m * SCALE)
            yield pd.DataFrame({"n": [len(pdf)], "dims": [dims], "ids": [pdf.id.to_numpy("int64").tobytes()],
                                "matrix": [m.astype("<i4" if abs(m).max(initial=0) < 2**31 else "<i8").tobytes()]})

    packed = rows.repartition(count, "id").mapInPandas(build, "n int, dims int, ids binary, matrix binary")
    return packed.select((F.shiftright(F.monotonically_increasing_id(), 33) % count).cast("int").alias(key), "*"), count


def search_shard(matrix: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
                 k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, vector ids, scores) of the k best of the shard for each query."""
    wide = max(matrix.shape[1], queries.shape[1])
    matrix, queries = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (matrix, queries))
    bound = float(abs(matrix).max(initial=0)) * float(abs(queries).max(initial=0)) * max(wide, 1)
    kind = np.float64 if bound < 2**53 else object  # exact in either
    order = np.argsort(ids, kind="stable")
    ids, postings = ids[order], np.ascontiguousarray(matrix[order].T).astype(kind)  # a row per term
    low, high = (postings.min(axis=1), postings.max(axis=1)) if len(ids) else (np.zeros(wide),) * 2
    best_first = np.argsort(postings, axis=1)[:, :k + 1], np.argsort(-postings, axis=1)[:, :k + 1]
    for q, qid in zip(queries.astype(kind), query_ids):
        others = np.flatnonzero(ids != qid)
        least, most = np.minimum(q * low, q * high), np.maximum(q * low, q * high)
        span = most - least
        terms = np.argsort(-span.astype(float), kind="stable")
        # Threshold: the k-th best of the vectors that lead the strongest terms.
        lead = np.unique(np.concatenate([best_first[int(q[t] > 0)][t] for t in terms[:16]] or [others[:0]]))
        lead = lead[ids[lead] != qid]
        scores = np.sort(q @ postings[:, lead]) if len(lead) else np.zeros(0)
        floor = scores[-k] if len(scores) >= k else None
        rest = np.append(np.cumsum(most[terms][::-1])[::-1], 0)  # the most that terms[i:] can give
        n_essential = wide
        if floor is not None:
            # Smallest essential set: with all essential terms at their least, the others cannot reach the floor.
            reach = np.append(0, np.cumsum(least[terms])) + rest
            below = np.flatnonzero(reach < floor)
            n_essential = min(wide, int(below[0]) if len(below) else wide)
        essential = terms[:n_essential]
        score = q[essential] @ postings[essential] if n_essential else np.zeros(len(ids), kind)
        live, score, at = others, score[others], n_essential
        while True:
            if floor is not None:
                keep = score + rest[at] >= floor
                live, score = live[keep], score[keep]
            if at >= wide or not len(live):
                break
            probe = terms[at:at + PROBE_TERMS]
            score = score + q[probe] @ postings[np.ix_(probe, live)]
            at += len(probe)
        top = np.lexsort((ids[live], -score))[:k] if kind is not object else \
            np.array(sorted(range(len(live)), key=lambda i: (-score[i], ids[live[i]]))[:k], dtype=int)
        yield int(qid), ids[live[top]], score[top]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row of ``queries`` its k
    best rows of ``vectors`` by integer inner product of floor(256 * x), without
    rows of the query's own id; ties to the smaller vec_id; fewer if there are fewer.

    Vectors that are null or hold null or non-finite components, and null ids,
    take no part. Shorter vectors count as 0 in the dimensions they lack; empty
    ones score 0. Of queries of one id the smallest vector is asked; repeated rows
    of ``vectors`` are candidates each. Empty tables give no rows.
    """
    asked = usable(queries, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v"))
    asked, n_blocks = _blocks(asked, QUERY_BLOCK, "b")
    asked = asked.select("b", F.col("n").alias("qn"), F.col("dims").alias("qdims"),
                         F.col("ids").alias("qids"), F.col("matrix").alias("qmatrix"))
    shards, n_shards = _blocks(usable(vectors, id_col, vec_col), shard_rows, "shard")
    # Every shard meets every block of the stated query set, dealt pair by pair.
    keys, tasks = ["shard", "b"], min(n_shards * n_blocks, 10_000)
    shards = shards.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    pairs = shards.repartition(tasks, *keys).join(asked.repartition(tasks, *keys), keys)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                m, q = (np.frombuffer(x, "<i4" if len(x) == 4 * n * d else "<i8").reshape(n, d).astype(np.int64)
                        for x, n, d in ((r.matrix, r.n, r.dims), (r.qmatrix, r.qn, r.qdims)))
                out = [pd.DataFrame({"query_id": qid, "vec_id": v, "score": s.astype(np.int64)}) for qid, v, s in
                       search_shard(m, np.frombuffer(r.ids, np.int64), q, np.frombuffer(r.qids, np.int64), k)]
                if out:
                    yield pd.concat(out)

    found = pairs.mapInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
