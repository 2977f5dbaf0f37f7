"""Line dedup by distinct-site spread (DataFrame functions only).

Every line hash gets a HyperLogLog sketch of the sites it occurs on; the
sketches merge by aggregation, so a line on a third of all pages moves as one
small sketch per task. Estimates far from the threshold decide at once; lines
whose estimate lies within a factor of two of it get an exact distinct count.
Lines on at least ``min_sites`` sites are boilerplate and are removed from every
document, all their repeats included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, cut, sha256_hex

MIN_SITES = 5
LG_K = 12
#: Sketches of 2^12 registers err by 1.6 % (one sigma); a factor of two is over 30 sigma.
BAND = 2.0


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h): hashes of lines on at least ``min_sites`` distinct sites; ``lines`` has (h, site)."""
    sketches = lines.groupBy("h").agg(F.hll_sketch_agg("site", LG_K).alias("s"))
    # Only lines that can reach the threshold go on; written so both branches read one result.
    spread = cut(sketches.select("h", F.hll_sketch_estimate("s").alias("n")).where(F.col("n") >= min_sites / BAND), "spread")
    sure = spread.where(F.col("n") > min_sites * BAND).select("h")
    near = spread.where(F.col("n") <= min_sites * BAND).select("h")
    exact = (lines.join(near, "h", "left_semi").groupBy("h", "site").agg(F.lit(1).alias("one"))
             .groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("h"))
    return cut(sure.unionByName(exact), "boilerplate")


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, kept_text, kept_sha256.

    Lines end at \\n and are compared without the white space [\\x20\\x09-\\x0D]
    around them; lines empty after that always stay. Null texts are empty (one
    empty line); null sites are the one site ""; repeated rows count one site and
    are each returned; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       F.coalesce(docs[site_col].cast("string"), F.lit("")).alias("site"))
    rows = rows.withColumn("row_key", F.xxhash64("doc_id", "text"))
    split = F.split("text", "\n", -1)
    bare = F.regexp_replace(F.col("line"), rf"^{WS_CLASS}+|{WS_CLASS}+$", "")
    lines = (rows.select("row_key", "doc_id", "site", F.posexplode(split).alias("pos", "line"))
             .select("row_key", "doc_id", "site", "pos", bare.alias("line")).where("line != ''")
             .select("row_key", "doc_id", "site", "pos", F.xxhash64("line").alias("h")))
    gone = boilerplate(lines.select("h", "site"), min_sites)
    # Positions to remove, per document; the hash join may be split on the lines' side.
    drop = (lines.select("row_key", "doc_id", "pos", "h").join(gone, "h", "left_semi")
            .groupBy("row_key", "doc_id").agg(F.collect_set("pos").alias("gone")))
    none = F.array().cast("array<int>")
    out = (rows.alias("r").join(drop.alias("d"), (F.col("r.row_key") == F.col("d.row_key"))
                                & F.col("r.doc_id").eqNullSafe(F.col("d.doc_id")), "left")
           .select("r.doc_id", F.split("r.text", "\n", -1).alias("lines"), F.coalesce("d.gone", none).alias("gone")))
    stay = F.filter("lines", lambda line, i: ~F.array_contains(F.col("gone"), i))
    out = out.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
                     F.array_join(stay, "\n").alias("kept_text"))
    return out.withColumn("kept_sha256", sha256_hex(F.col("kept_text")))
