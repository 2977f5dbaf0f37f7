"""The corpus pipeline: five of the training-data operators one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's documents; all but the last return the
columns of ``documents``. ``run`` applies them to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notaflow.llm import fm_dedup, jaccard, packing, quality, queries, radix_dedup
from notaflow.llm.common import cut, table

#: Near copies of the corpus share 80 % of their shingles of five words (op7 alone: 85 % of four).
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, unchanged."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts. Rows of one id go together; fully
    repeated rows are one."""
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        docs = docs.dropDuplicates()
    return _with_ids(docs, radix_dedup.exact_groups(docs).where("kept").select("doc_id"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of similar documents; rows without id stay."""
    found = jaccard.similar_components(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)
    return _with_ids(docs, found.where("doc_id <=> component_id").select("doc_id"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat from smaller ids: a text that loses
    words is its kept words joined by one space, any other text is unchanged."""
    # Columns travel under names that no operator output has.
    own = {c: f"own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = fm_dedup.remove_repeats(docs.select("doc_id", "text", *[docs[c].alias(a) for c, a in own.items()]),
                                  carry=("text", *own.values()))
    cut_short = F.col("n_removed") > 0
    text = F.when(cut_short, F.col("kept_text")).otherwise(F.col("text"))
    back = {c: F.col(a) for c, a in own.items()} | {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in own:
        back["n_chars"] = F.when(cut_short, F.length(text).cast("long")).otherwise(F.col(own["n_chars"]))
    return out.select(*[back[c].alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows in the corpus' mixture of sources."""
    return packing.pack(docs, queries.tokenizer("word_bpe_49k.json"))


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.withColumnRenamed("doc_id", "kept_id")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["kept_id"]), "left_semi")


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: Expectation-maximisation, a trained scorer and tokenisation can't be said in SQL;
#: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
