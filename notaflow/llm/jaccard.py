"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

1. Documents with equal shingle sets are one class; only its representative, the
   smallest id, goes on (copies in any number cost one row per task).
2. Candidates by prefix: with one global order of shingles, linked documents
   share k of their first n - ceil(0.85 n) + k (k: 1 + 4 % of n). Any order is exact; this
   one puts long shingles (rare ones) first and those that occur in more than
   one in a thousand documents last, so common lines, passages and phrases
   bring nobody together. A shingle's bucket is parted by size; a document joins the
   group of the smallest document (hub) in each part where the size bound can be met.
   Documents that share fewer than k such shingles with others leave beforehand.
3. Groups are dealt into blocks of at most BLOCK documents. A block's incidence
   matrix times its transpose, accumulated over blocks of columns, gives overlap
   counts; pairs below the bound that their sizes imply are discarded. Only a
   spanning forest of the links leaves a task, never all pairs of a group.
   In a group of several blocks the hub stands in each; documents that a block
   has not connected to the hub meet the other blocks in a second product.
4. Components of the forest, by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, slices
from .words import HashedWords, grams

SHINGLE = 4
PERCENT = 85
BLOCK = 1000
COLUMNS = 4096
#: A shingle in more than this share of the documents sorts last. The set is
#: bounded: at most 1000 times the mean number of shingles of a document.
COMMON_SHARE = 0.001
COMMON_IN_SLICE = 3
#: A prefix has one shingle more per SPARE shingles of the set than one common shingle needs.
SPARE = 25


def shingle_sets(words: HashedWords, texts: list[str], n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(distinct shingle hashes ascending, their word bytes) of each text; a text of
    fewer than n words has its whole sequence as the one shingle, an empty one none."""
    h, length, count = words(texts)
    g = grams(h, n)
    size = np.concatenate([[0], np.cumsum(length)])
    sets, sizes = [], []
    at = 0
    for c in count:
        if c >= n:
            s, first = np.unique(g[at:at + c - n + 1], return_index=True)
            sets.append(s)
            sizes.append((size[at + first + n] - size[at + first]))
        else:
            sets.append(grams(h[at:at + c], c) if c else np.zeros(0, np.uint64))
            sizes.append(np.full(len(sets[-1]), size[at + c] - size[at]))
        at += c
    return sets, sizes


def least_overlap(a, b, percent: int = PERCENT):
    """The smallest overlap of linked sets of a and b shingles: 100 o >= percent (a + b - o)."""
    return -(-(percent * (a + b)) // (100 + percent))


def common_shingles(rows: DataFrame, n: int, share: float) -> np.ndarray:
    """Shingles of many documents; counted over all documents. Only shingles met a few
    times within one slice are counted, which can lower a count near the share: the
    order of shingles is the only thing that depends on this set."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = HashedWords(lower=True)
        for pdf in slices(batches, budget=1 << 20):
            sets, _ = shingle_sets(words, pdf.text.tolist(), n)
            s, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            often = c >= COMMON_IN_SLICE
            yield pd.DataFrame({"s": s[often].astype(np.int64), "n": c[often]})

    total = rows.count()
    top = (rows.mapInPandas(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
           .where(F.col("n") > max(10, share * total)).select("s").toPandas())
    return np.sort(top.s.to_numpy(np.int64).astype(np.uint64))


def signatures(rows: DataFrame, n: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, n, digest of the set, prefix) of each row."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = HashedWords(lower=True)
        for pdf in slices(batches, budget=1 << 20):
            sets, sizes = shingle_sets(words, pdf.text.tolist(), n)
            prefix, digest = [], []
            for s, size in zip(sets, sizes):
                at = np.minimum(np.searchsorted(common, s), max(0, len(common) - 1))
                late = common[at] == s if len(common) else np.zeros(len(s), bool)
                take = len(s) - -(-percent * len(s) // 100) + common_prefix(len(s)) if len(s) else 0
                prefix.append(s[np.lexsort((s, -size, late))[:take]].astype(np.int64))
                digest.append(xxhash.xxh128_digest(s.tobytes()))
            yield pd.DataFrame({"doc_id": pdf.doc_id.astype("Int64"), "n": [len(s) for s in sets], "digest": digest,
                                "prefix": prefix})

    return rows.mapInPandas(sign, "doc_id long, n long, digest binary, prefix array<long>")


def overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all pairs, accumulated over column blocks of the two incidence
    matrices; columns that only one side or one document has cannot count."""
    if len(sets_a) * len(sets_b) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in sets_b] for a in sets_a], np.int32)

    def flat(sets):
        return np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (va, ra), (vb, rb) = flat(sets_a), flat(sets_b)
    shared = np.intersect1d(va, vb)
    out = np.zeros((len(sets_a), len(sets_b)), np.int32)
    (ca, ra), (cb, rb) = ((np.searchsorted(shared, v), r) for v, r in ((va, ra), (vb, rb)))
    keep_a, keep_b = ((shared[np.minimum(c, len(shared) - 1)] == v) if len(shared) else np.zeros(len(v), bool)
                      for c, v in ((ca, va), (cb, vb)))
    ca, ra, cb, rb = ca[keep_a], ra[keep_a], cb[keep_b], rb[keep_b]
    for lo in range(0, len(shared), COLUMNS):
        m = []
        for c, r, rows in ((ca, ra, len(sets_a)), (cb, rb, len(sets_b))):
            inside = (c >= lo) & (c < lo + COLUMNS)
            x = np.zeros((rows, min(COLUMNS, len(shared) - lo)), np.float32)
            x[r[inside], c[inside] - lo] = 1
            m.append(x)
        out += (m[0] @ m[1].T).astype(np.int32)
    return out


def linked(sets_a: list[np.ndarray], sets_b: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (in a, in b) of all linked pairs of two blocks."""
    n, m = (np.array([len(s) for s in x], np.int64) for x in (sets_a, sets_b))
    need = least_overlap(n[:, None], m[None, :], percent)
    return np.nonzero((overlaps(sets_a, sets_b) >= need) & (need > 0))


def forest(ids: np.ndarray, pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """id -> smallest id reachable over the pairs."""
    root = {int(i): int(i) for i in ids}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def common_prefix(n):
    """Linked sets of at least n shingles share at least this many of their prefixes:
    a prefix of n - ceil(percent n / 100) + k shingles holds the k first common ones."""
    return 1 + F.floor(n / F.lit(SPARE)) if isinstance(n, Column) else 1 + n // SPARE


def thin(live: DataFrame, percent: int) -> DataFrame:
    """Prefix rows (doc_id, n, i, s, z) that can still belong to a link: the shingle has
    another document in its size class, and the document has as many such shingles
    in the class as it would share with a linked document of the smallest size."""
    met = cut(live.groupBy("s", "z").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("s", "z"), "jaccard-met")
    live = cut(live.join(met, ["s", "z"]), "jaccard-live")
    least = common_prefix(F.ceil(F.col("n") * F.lit(percent) / F.lit(100)).cast("long"))
    enough = (live.groupBy("doc_id", "z", "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= least)
              .select("doc_id", "z"))
    return cut(live.join(cut(enough, "jaccard-enough"), ["doc_id", "z"]), "jaccard-thin")


def link_classes(reps: DataFrame, texts: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """(a, b): a spanning forest of the links among ``reps`` (doc_id, n, prefix)."""
    rows = reps.select("doc_id", "n", F.posexplode("prefix").alias("i", "s"))
    shared = cut(rows.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("s"), "jaccard-shared")
    # Linked sets differ in size by at most 100/percent: they meet in one of two neighbouring size classes.
    size_class = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)))).cast("int")
    live = rows.join(shared, "s").withColumn("z", F.explode(F.array(size_class, size_class + 1)))
    live = thin(live, percent)
    need = (F.lit(percent) * (F.col("n") + F.col("least")) + F.lit(percent + 99)) / F.lit(100 + percent)
    buckets = cut(live.groupBy("s", "z").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("hub"),
                                             F.min("n").alias("least")).where("c > 1").drop("c"), "jaccard-buckets")
    members = (live.join(buckets, ["s", "z"]).where(F.col("n") - F.col("i") >= F.floor(need))
               .select("hub", "doc_id").where("hub <> doc_id").distinct())
    members = cut(members, "jaccard-members")
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    hubs = cut(sizes.select("hub", F.ceil((F.col("size") + 1) / F.lit(block)).cast("int").alias("k")), "jaccard-groups")
    # The hub stands in every block of its group; the others in one.
    placed = cut(members.join(hubs, "hub").withColumn("b", F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int"))
                 .unionByName(hubs.select("hub", F.col("hub").alias("doc_id"), "k",
                                          F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("b"))), "jaccard-placed")

    def sets_of(pdf: pd.DataFrame) -> list[np.ndarray]:
        return shingle_sets(HashedWords(lower=True), pdf.text.tolist(), n)[0]

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf.doc_id.to_numpy()
        i, j = linked(s := sets_of(pdf), s, percent)
        root = forest(ids, zip(ids[i].tolist(), ids[j].tolist()))
        hub = int(pdf.hub.iloc[0])
        out = pd.DataFrame({"a": list(root), "b": list(root.values())})
        return out.assign(hub=hub, loose=[r != root[hub] and pdf.k.iloc[0] > 1 for r in root.values()])

    inside = cut(placed.join(texts, "doc_id").groupBy("hub", "b").applyInPandas(within, "a long, b long, hub long, loose boolean"), "jaccard-inside")
    edges = inside.select("a", "b").where("a <> b")
    loose = inside.where("loose").select("hub", F.col("a").alias("doc_id")).distinct()
    if loose.isEmpty():
        return edges

    # What its own block has not tied to the hub meets every other block of the group.
    many = placed.where("k > 1").join(texts, "doc_id")
    seek = many.join(loose, ["hub", "doc_id"], "left_semi").where("hub <> doc_id")
    # Loose documents travel in chunks of a block's size to each block.
    pieces = seek.groupBy("hub").agg(F.count(F.lit(1)).alias("l"))
    seek = (seek.join(pieces, "hub").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("l") / F.lit(block)))
                                                .cast("int"))
            .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
            .select("hub", "part", F.col("to").alias("b"), "doc_id", "text", F.lit(True).alias("seeks")))
    stay = (many.join(pieces, "hub")
            .withColumn("part", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("l") / F.lit(block)) - 1).cast("int"))))
            .select("hub", "part", "b", "doc_id", "text", F.lit(False).alias("seeks")))

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf.seeks], pdf[~pdf.seeks]
        i, j = linked(sets_of(a), sets_of(b), percent)
        x, y = a.doc_id.to_numpy()[i], b.doc_id.to_numpy()[j]
        root = forest(np.concatenate([x, y]), zip(x.tolist(), y.tolist()))
        return pd.DataFrame({"a": list(root), "b": list(root.values())})

    more = seek.unionByName(stay).groupBy("hub", "part", "b").applyInPandas(across, "a long, b long")
    return edges.unionByName(more.where("a <> b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): smallest node reachable, for every node of ``edges`` (a, b);
    alternating large-star and small-star rounds until nothing changes."""
    at = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return at.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = state
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = cut(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .where("a <> b").distinct(), "large-star")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        tied = large.join(least, "a")
        at = cut(tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT, block: int = BLOCK, common_share: float = COMMON_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id
    reachable over links, itself included).

    Words are [^\\x20\\x09-\\x0D]+ with A-Z in lower case; two documents link when
    100 * overlap >= percent * union of their distinct shingles. Null and empty
    texts have no shingles and link with nothing; texts of fewer words than a
    shingle are one shingle; equal rows are one document; a row without id links
    with nothing and has no component; an empty table gives no rows.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    named = rows.where("doc_id is not null")
    signed = cut(signatures(rows, shingle, percent, common_shingles(rows, shingle, common_share)), "jaccard-signed")
    classes = (signed.where("n > 0 and doc_id is not null").groupBy("digest", "n")
               .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix")))
    classes = cut(classes, "jaccard-classes")
    edges = link_classes(classes.select(F.col("rep").alias("doc_id"), "n", "prefix"), named.dropDuplicates(["doc_id"]),
                         shingle, percent, block)
    label = components(edges)
    of_class = cut(classes.select("digest", "n", "rep").join(label, F.col("rep") == F.col("node"), "left")
                   .select("digest", "n", F.coalesce("label", "rep").alias("component")), "jaccard-components")
    return (signed.drop("prefix").join(of_class, ["digest", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))
