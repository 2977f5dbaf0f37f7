"""Exactly-once micro-batches and a key index beside dated data (SNK-14, STR-1, STR-3, STR-4).

A batch writes each of its outputs into a folder of its own, ``<table>/lote=<name>``,
that a retry replaces whole; Spark's success marker commits it, and readers take
committed folders only. So a batch that failed after any of its writes and runs again
leaves each row once.

Keys that are stored already are found by key, not by date: beside the data lies an
index of the keys, in buckets by hash, and a Bloom filter of it in blocks of 32,768
bits. A batch joins the filter's blocks first; rows that it does not know are new. Of
the index only the buckets of the others are read. A retried batch does not count what
it indexed itself; data whose batch failed before it was indexed is indexed by the
next one. One writer at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.loading import dedupe_by_key

#: Buckets of the key index, blocks of its Bloom filter, bits that a key sets.
BUCKETS, BLOCKS, PROBES = 32, 1024, 4
_BLOCK_BITS = 32768  # what one bitmap of bitmap_construct_agg holds
LOT = "lote"


def lot_name(checkpoint: str, batch_id: int) -> str:
    """The name of a stream's batch: the same for a retry, another for a fresh checkpoint."""
    return f"{zlib.crc32(checkpoint.encode()):08x}-{batch_id:09d}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the table's committed batches (a listing of folders, no data)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    done = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(f"{LOT}=")]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(d.getName()[len(LOT) + 1:] for d in done if fs.exists(marker(d, "_SUCCESS")))


def write_lot(df: DataFrame, path: str, lot: str, *partition_by: str) -> None:
    """The batch's output, in place of what an earlier attempt left."""
    w = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/{LOT}={lot}")


def read_lots(spark: SparkSession, path: str, lots: Sequence[str], schema: str | None = None) -> DataFrame:
    """Some committed batches as one table, without the batch names; with a schema also
    when none of them holds a row."""
    r = spark.read.option("basePath", path)
    if schema:
        r = r.schema(f"{schema}, {LOT} string")
    return r.parquet(*[f"{path}/{LOT}={x}" for x in lots]).drop(LOT)


def _bloom(spark: SparkSession, path: str, lots: Sequence[str]) -> DataFrame:
    return read_lots(spark, f"{path}/bloom", lots, "bloco int, bits binary")


def _keys(spark: SparkSession, path: str, lots: Sequence[str], kind: str) -> DataFrame:
    return read_lots(spark, f"{path}/chaves", lots, f"chave {kind}, balde int")


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _block(key: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("bloco")), F.lit(BLOCKS)).cast("int")


def _places(key: str) -> list[Column]:
    """The bits of a key within its block."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(_BLOCK_BITS)) for i in range(PROBES)]


def _bit(bits: str, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


def bloom_blocks(keys: DataFrame, key: str) -> DataFrame:
    """(bloco, bits): the filter of some keys; combinable before the shuffle."""
    places = keys.select(_block(key).alias("bloco"), F.explode(F.array(*_places(key))).alias("p"))
    return places.groupBy("bloco").agg(F.bitmap_construct_agg("p").alias("bits"))


def maybe_known(rows: DataFrame, blocks: DataFrame, key: str, in_place: bool = False) -> DataFrame:
    """``rows`` with ``__talvez``: False where the filter proves that the key is not stored.
    ``in_place``: the rows stay where they are and the filter goes to them (BLOCKS blocks
    of 4 KB, whatever the number of keys)."""
    merged = blocks.groupBy(F.col("bloco").alias("__bloco")).agg(F.bitmap_or_agg("bits").alias("__bits"))
    merged = F.broadcast(merged) if in_place else merged
    hit = F.col("__bits").isNotNull()
    for p in _places(key):
        hit = hit & _bit("__bits", p)
    joined = rows.join(merged, _block(key) == F.col("__bloco"), "left")
    return joined.withColumn("__talvez", F.coalesce(hit, F.lit(False))).drop("__bloco", "__bits")


def _index(rows: DataFrame, path: str, key: str, lot: str) -> None:
    keys = rows.select(F.col(key).alias("chave"), _bucket(key).alias("balde"))
    write_lot(bloom_blocks(keys, "chave"), f"{path}/bloom", lot)
    write_lot(keys.hint("rebalance", F.col("balde")), f"{path}/chaves", lot, "balde")


def index_missing(spark: SparkSession, path: str, key: str, but: str) -> list[str]:
    """Index the committed data of batches that failed before their keys were."""
    known = set(committed(spark, f"{path}/chaves")) & set(committed(spark, f"{path}/bloom"))
    known |= {x for b in committed(spark, f"{path}/fundidos") for x in
              [r[0] for r in spark.read.parquet(f"{path}/fundidos/{LOT}={b}").collect()]}
    missing = [x for x in committed(spark, f"{path}/dados") if x not in known and x != but]
    for x in missing:
        if _holds_rows(spark, path, x):
            _index(read_lots(spark, f"{path}/dados", [x]), path, key, x)
    return missing


def unseen(rows: DataFrame, path: str, key: str, lot: str) -> DataFrame:
    """The rows, one per key and with ``__talvez``, whose key no other batch has stored."""
    spark = rows.sparkSession
    # Bounded by BUCKETS: the buckets of keys that the filter may know.
    touched = [r[0] for r in rows.where("__talvez").select(_bucket(key)).distinct().collect()]
    lots = [x for x in committed(spark, f"{path}/chaves") if x != lot]
    if not touched or not lots:
        return rows
    stored = _keys(spark, path, lots, rows.schema[key].dataType.simpleString())
    stored = stored.where(F.col("balde").isin(touched)).select(F.col("chave").alias("__chave"))
    old = rows.where("__talvez").join(stored, F.col(key).eqNullSafe(F.col("__chave")), "left_anti")
    return rows.where("NOT __talvez").unionByName(old)


def append_once(batch: DataFrame, path: str, key: str, lot: str, *partition_by: str,
                sort_by: Sequence[str] = ()) -> DataFrame:
    """Store the rows of a batch whose key is stored neither by it nor by any other
    batch, whatever partition that row lies in; returns what the batch has stored.
    Exact for any split into batches, and a batch may run again after any failure.
    Of the rows of one key in a batch the smallest is taken; a null key is a key like
    any other."""
    spark = batch.sparkSession
    index_missing(spark, path, key, but=lot)
    rows = dedupe_by_key(batch, key)
    blooms = [x for x in committed(spark, f"{path}/bloom") if x != lot]
    if blooms:
        rows = maybe_known(rows, _bloom(spark, path, blooms), key).persist()
        fresh = unseen(rows, path, key, lot).drop("__talvez")
    else:
        fresh = rows
    if partition_by:
        fresh = fresh.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        fresh = fresh.sortWithinPartitions(*sort_by)
    write_lot(fresh, f"{path}/dados", lot, *partition_by)
    rows.unpersist()
    mine = read_lots(spark, f"{path}/dados", [lot]) if _holds_rows(spark, path, lot) else \
        spark.createDataFrame([], batch.schema)
    _index(mine, path, key, lot)
    return mine


def _holds_rows(spark: SparkSession, path: str, lot: str) -> bool:
    """Whether the batch has any part file (partitioned writes of nothing leave none)."""
    fs, p = _fs(spark, f"{path}/dados/{LOT}={lot}")
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def read_store(spark: SparkSession, path: str, schema=None, only: Callable[[str], bool] = lambda lot: True) -> DataFrame:
    """All rows that ``append_once`` has stored (``only``: in some batches); before the
    first, an empty table of ``schema``."""
    lots = [x for x in committed(spark, f"{path}/dados") if only(x) and _holds_rows(spark, path, x)]
    return read_lots(spark, f"{path}/dados", lots) if lots else spark.createDataFrame([], schema)


def compact_keys(spark: SparkSession, path: str, name: str, kind: str) -> int:
    """Fold the index and filter of finished batches into one named ``name`` (without a
    dash; ``kind``: type of the key), so their number stays small; returns how many
    were folded. The newest batch of each stream stays as it is,
    since it may yet run again. Keys are a set: a failure in between does no harm."""
    newest: dict[str, str] = {}
    done = sorted(set(committed(spark, f"{path}/chaves")) & set(committed(spark, f"{path}/bloom")))
    for x in done:
        newest[x.rsplit("-", 1)[0]] = x
    fold = [x for x in done if x not in newest.values()]
    if len(fold) < 2:
        return 0
    write_lot(spark.createDataFrame([(x,) for x in fold], "lote_fundido string"), f"{path}/fundidos", name)
    keys = _keys(spark, path, fold, kind).distinct()
    write_lot(keys.hint("rebalance", F.col("balde")), f"{path}/chaves", name, "balde")
    bits = _bloom(spark, path, fold).groupBy("bloco").agg(F.bitmap_or_agg("bits").alias("bits"))
    write_lot(bits, f"{path}/bloom", name)
    for table in ("chaves", "bloom"):
        for x in fold:
            fs, p = _fs(spark, f"{path}/{table}/{LOT}={x}")
            fs.delete(p, True)
    return len(fold)
