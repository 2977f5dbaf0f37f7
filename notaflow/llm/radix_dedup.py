"""Exact dedup by distributed MSD radix partitioning (DataFrame functions only).

Each round splits every group that is still open by the next block of bytes of
its texts (the digit). A group leaves when one row is left in it or when its
texts have ended: its members then agree in every byte, so equality needs no
digest. Digits grow fourfold from 256 bytes, so the number of rounds is
logarithmic in the longest text, and after the first digit only rows whose
first 256 bytes are shared move again.

Skew: a group of copies with a third of all rows is counted with map-side
partial aggregation (one row per task and digit reaches a reducer), and the
counts are joined back by an equi-join that AQE may split on the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, cut

FIRST_DIGIT = 256
DIGIT_GROWTH = 4
MAX_DIGIT = 1 << 20


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 first_digit: int = FIRST_DIGIT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting white space [\\x20\\x09-\\x0D];
    a null text is empty (all empty texts are one group). Of a group the row with
    the most code points, then the smallest id stays; a null id sorts after all
    ids; of fully repeated rows exactly one is kept. An empty table gives no rows.
    Further columns are ignored, whatever their names.
    """
    norm = F.regexp_replace(F.coalesce(docs[text_col], F.lit("")), WS_CLASS + "+", "").cast("binary")
    base = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(F.length(docs[text_col]), F.lit(0)).alias("n_cp"), norm.alias("norm"))
    # The row number names rows and groups; it is fixed by being written.
    state = cut(base.select(F.monotonically_increasing_id().alias("rid"), F.lit(0).cast("long").alias("gid"),
                            "doc_id", "n_cp", F.unhex(F.sha2("norm", 256)).alias("sha"),
                            *_split("norm", first_digit)), "radix-0")
    width, done = first_digit, []
    while True:
        after = min(width * DIGIT_GROWTH, MAX_DIGIT)
        state = _round(state, width, after, len(done) + 1)
        done.append(state.where("ended").select("rid", "gid", "doc_id", "n_cp", "sha"))
        state, width = state.where("not ended"), after
        if state.isEmpty():
            break
    return _choose(done)


def _split(col: str, width: int):
    """The next digit and what follows it."""
    return (F.expr(f"substring({col}, 1, {width})").alias("digit"),
            F.expr(f"substring({col}, {width + 1})").alias("rest"))


def _round(state: DataFrame, width: int, after: int, k: int) -> DataFrame:
    groups = (state.groupBy("gid", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("new_gid"))
              .where("n > 1").drop("n"))
    # Written first: a plain join of two exchanges, whose skewed side AQE may split.
    split = state.join(cut(groups, f"radix-groups-{k}"), ["gid", "digit"], "left")
    ended = F.col("new_gid").isNull() | (F.length("digit") < width)
    rest = F.when(~ended, F.col("rest"))
    out = split.select("rid", F.coalesce("new_gid", "rid").alias("gid"), "doc_id", "n_cp", "sha",
                       ended.alias("ended"), rest.alias("tail"))
    return cut(out.select("rid", "gid", "doc_id", "n_cp", "sha", *_split("tail", after), "ended"),
               f"radix-{k}", "ended")


def _choose(done: list[DataFrame]) -> DataFrame:
    rows = done[0]
    for d in done[1:]:
        rows = rows.unionByName(d)
    best = F.min(F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("z"),
                          F.col("doc_id").alias("keep_id"), F.col("rid").alias("keep_rid")))
    groups = rows.groupBy("gid").agg(F.count(F.lit(1)).alias("n"), best.alias("b")).where("n > 1")
    return (rows.join(cut(groups, "radix-kept"), "gid", "left")
            .select("doc_id",
                    F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("b.keep_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("b.keep_rid") == F.col("rid"), F.lit(True)).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))
