"""Helpers shared by the operators: inputs under fixed names, written cuts, batch slicing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_at_exit, scratch_path

#: White space of all word rules: space and U+0009..U+000D, what ``bytes.split()`` splits on.
WS_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once under the cluster's shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, and fixes generated ids. The files
    go when the application ends."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    delete_at_exit(df.sparkSession, path)
    # The written schema is known: also an empty table (no part files) reads back.
    fields = [f for f in df.schema.fields if f.name not in partition_by]
    fields += [f for f in df.schema.fields if f.name in partition_by]
    return df.sparkSession.read.schema(type(df.schema)(fields)).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty; other columns of ``docs`` never
    enter an operator, so their names cannot clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def slices(batches: Iterator[pd.DataFrame], col: str = "text", budget: int = 4 << 20) -> Iterator[pd.DataFrame]:
    """Arrow batches cut so that one piece holds about ``budget`` characters
    (a longer single text stays whole): bounds the workers' memory."""
    for pdf in batches:
        start, held = 0, 0
        for i, n in enumerate(pdf[col].str.len()):
            if held and held + n > budget:
                yield pdf.iloc[start:i]
                start, held = i, 0
            held += n
        if start < len(pdf):
            yield pdf.iloc[start:]


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


class WordTable:
    """A worker's bounded memory of word -> ids: each word is encoded when first
    met; a full table starts afresh, which changes speed only."""

    def __init__(self, encode, dtype, capacity: int = 1_500_000):
        self.encode, self.dtype, self.capacity = encode, dtype, capacity
        self._clear()

    def _clear(self) -> None:
        self.index, self.flat = _Numbering(), np.zeros(0, self.dtype)
        self.at, self.len = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def flat_ids(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after another; number of ids of each word)."""
        if len(self.index) > self.capacity:
            self._clear()
        k = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            flat, lens = self.encode(self.index.new)
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(lens) - lens])
            self.len = np.concatenate([self.len, lens])
            self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
            self.index.new = []
        return gather(self.flat, self.at[k], self.len[k]), self.len[k]

    def ids(self, texts_words: list[list]) -> list[np.ndarray]:
        """Ids of each text's words, one after another."""
        flat, lens = self.flat_ids([w for ws in texts_words for w in ws])
        ends = np.cumsum(np.concatenate([[0], lens]))[np.cumsum([len(ws) for ws in texts_words], dtype=np.int64)]
        return np.split(flat, ends[:-1]) if len(texts_words) else []


class _Numbering(dict):
    """word -> number in order of first sight; ``new``: words not yet encoded."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, word):
        n = self[word] = len(self)
        self.new.append(word)
        return n


def gather(flat: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[at[i] : at[i] + length[i]] of all i, concatenated."""
    ends = np.cumsum(length)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - length), length)]
