"""Structured Streaming versions of the incremental jobs (STR-1..6).

The reference re-reads an overlapping 72-hour window every 3 hours and drops
rows whose hash is already stored. Here that is a file-source stream whose
micro-batches are de-duplicated exactly, inside the batch and against a key index
beside the store (``sinks/lots.py``), so an id that is sent again on another day is
stored once. Those jobs have no watermark, so no row is lost however late or in whatever
order files come; ``stream_dedup_state`` keeps recent ids in Spark's state store instead
and gives what the watermark drops a table of its own. Each batch writes under its own
name and may run again.
``trigger(availableNow=True)`` drains a backlog (the historic backfill) and
stops; the same checkpoint then serves the incremental runs. Outputs and
checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import loading
from ..session import scratch_path
from ..sinks import lots
from ..sinks.tables import path_exists

#: Partition column of stores that a stream writes.
DAY = "dia"


def file_stream(spark: SparkSession, folder: str, schema: StructType, glob: str | None = None,
                max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:  # nothing depends on the order of files: the newest are read first
        r = r.option("maxFilesPerTrigger", str(max_files)).option("latestFirst", "true")
    return r.load(folder)


def run_available(query_builder, out_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet", foreach=None) -> None:
    """Drain everything available now, then stop."""
    w = query_builder.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if foreach is not None:
        w = w.foreachBatch(foreach)
    else:
        w = w.format(fmt).option("path", out_path)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()


def stream_dedup(spark: SparkSession, folder: str, schema: StructType, glob: str, key: str,
                 time_col: str, copies: int = 2, max_files: int | None = None) -> DataFrame:
    """STR-1 + STR-4 end to end over a file stream read ``copies`` times
    (overlapping re-reads); returns the stored result."""
    s = file_stream(spark, folder, schema, glob, max_files)
    for _ in range(copies - 1):
        s = s.unionByName(file_stream(spark, folder, schema, glob, max_files))
    s = s.withColumn(DAY, F.to_date(time_col))
    out, ck = scratch_path(spark, "stream_dedup_out"), scratch_path(spark, "stream_dedup_ck")
    run_available(s, out, ck, foreach=lambda b, i: lots.append_once(b, out, key, lots.lot_name(ck, i), DAY))
    return lots.read_store(spark, out, s.schema).drop(DAY)


#: Event time and the mark of rows that the state let pass, while a batch is under way.
_WHEN, _PASSED = "__quando", "__passou"


def state_dedup(stream: DataFrame, store: str, checkpoint: str, key: str, time_col: str, delay: str = "72 hours") -> None:
    """STR-1 on keyed state: drain ``stream`` into ``store``, one row per key.

    ``dropDuplicatesWithinWatermark`` holds the keys of the last ``delay`` in the state
    store, so a row sent again within it is dropped without reading what is stored. What
    comes later than the watermark, which Spark drops uncounted, goes to the late lots of
    the same store (``late_rows``) if its key is not stored yet; so do rows without a
    time. The same micro-batch holds every row beside those that passed: of the others
    only rows not after the newest time of earlier batches less ``delay`` can have been
    dropped as late, and only those are looked up in the key index.

    Stored rows are one per key for any order and split of files, if rows of one key
    have one time; a key that comes again more than ``delay`` after its first time, and
    before the watermark passes that, is a new row (``stream_dedup`` stores it once).
    Empty batches leave the store as it is. At scale the session should keep state in
    RocksDB (``spark.sql.streaming.stateStore.providerClass``, set by ``get_spark``)."""
    rows = stream.withColumn(_WHEN, F.col(time_col).cast("timestamp")).withColumn(DAY, F.to_date(time_col))
    passed = (rows.where(F.col(_WHEN).isNotNull()).withWatermark(_WHEN, delay)
              .dropDuplicatesWithinWatermark([key]).withColumn(_PASSED, F.lit(True)))
    both = rows.withColumn(_PASSED, F.lit(False)).unionByName(passed)

    def batch(b: DataFrame, batch_id: int) -> None:
        spark, lot = b.sparkSession, lots.lot_name(checkpoint, batch_id)
        b = b.persist()  # the state is updated once
        out = b.where(_PASSED).drop(_WHEN, _PASSED)
        lots.write_lot(out.hint("rebalance", F.col(DAY)), f"{store}/dados", lot, DAY)
        before = [x for x in lots.committed(spark, f"{store}/limites") if x != lot]
        newest = lots.read_lots(spark, f"{store}/limites", before).agg(F.max("ate")).first()[0] if before else None
        lots.write_lot(b.agg(F.max(_WHEN).alias("ate")), f"{store}/limites", lot)
        late = F.col(_WHEN).isNull()
        if newest is not None:
            late = late | (F.col(_WHEN) <= F.lit(newest) - F.expr(f"INTERVAL {delay}"))
        rest = b.where(~F.col(_PASSED) & late).drop(_WHEN, _PASSED)
        lots.append_once(rest, store, key, lots.lot_name(_late(checkpoint), batch_id), DAY)
        b.unpersist()

    run_available(both, store, checkpoint, foreach=batch)


def _late(checkpoint: str) -> str:
    return f"{checkpoint}/atrasados"


def late_rows(spark: SparkSession, store: str, checkpoint: str, schema: StructType) -> DataFrame:
    """What ``state_dedup`` has stored of rows later than the watermark, or without a time."""
    mine = lots.lot_name(_late(checkpoint), 0).rsplit("-", 1)[0]
    return lots.read_store(spark, store, schema, lambda x: x.startswith(f"{mine}-")).drop(DAY)


def stream_dedup_state(spark: SparkSession, folder: str, schema: StructType, glob: str, key: str, time_col: str,
                       delay: str = "72 hours", copies: int = 2, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``state_dedup`` over a file stream read ``copies`` times; (all that is stored, the late ones of it)."""
    s = file_stream(spark, folder, schema, glob, max_files)
    for _ in range(copies - 1):
        s = s.unionByName(file_stream(spark, folder, schema, glob, max_files))
    store, ck = scratch_path(spark, "stream_state_out"), scratch_path(spark, "stream_state_ck")
    state_dedup(s, store, ck, key, time_col, delay)
    with_day = s.withColumn(DAY, F.to_date(time_col)).schema
    return lots.read_store(spark, store, with_day).drop(DAY), late_rows(spark, store, ck, with_day)


def stream_status(spark: SparkSession, folder: str, schema: StructType, glob: str,
                  group_col: str, value_col: str, max_files: int | None = None) -> DataFrame:
    """STR-6: running counts and sums per group. A micro-batch writes its own partial sums
    once; reading merges them, so a batch's work follows the batch, not the groups so far."""
    s = file_stream(spark, folder, schema, glob, max_files)
    out, ck = scratch_path(spark, "stream_status_out"), scratch_path(spark, "stream_status_ck")

    def keep(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(group_col).agg(F.count(F.lit(1)).alias("total_linhas"),
                                            F.sum(F.col(value_col).cast("decimal(38,9)")).alias("valor_total"))
        lots.write_lot(part, out, lots.lot_name(ck, batch_id))

    run_available(s, out, ck, foreach=keep)
    done = lots.committed(spark, out)
    if not done:
        return spark.createDataFrame([], f"{group_col} {schema[group_col].dataType.simpleString()}, "
                                         "total_linhas long, valor_total double")
    return lots.read_lots(spark, out, done).groupBy(group_col).agg(
        F.sum("total_linhas").alias("total_linhas"), F.sum("valor_total").cast("double").alias("valor_total"))


def stream_kpis(spark: SparkSession, folder: str, schema: StructType, glob: str, key: str, time_col: str,
                user_col: str, value_col: str, window_hours: int = 3, max_files: int | None = None) -> DataFrame:
    """STR-5: live KPIs by tumbling window, with exact distinct users. A micro-batch
    adds its new events to a store partitioned by day and replaces the windows of
    the days it added to (windows divide a day), so every window is there at once
    and late events correct it. An event sent again counts once, on whatever day."""
    if 24 % window_hours:
        raise ValueError("windows must divide a day")
    s = file_stream(spark, folder, schema, glob, max_files).withColumn(DAY, F.to_date(time_col))
    store, out, ck = (scratch_path(spark, f"stream_kpis_{x}") for x in ("store", "out", "ck"))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        added = lots.append_once(batch, store, key, lots.lot_name(ck, batch_id), DAY)
        days = [r[0] for r in added.select(DAY).distinct().collect() if r[0] is not None]  # bounded by the calendar
        if not days:
            return
        kpis = (lots.read_store(spark, store).where(F.col(DAY).isin(days)).groupBy(DAY, F.window(F.col(time_col).cast("timestamp"), f"{window_hours} hours").alias("janela"))
                .agg(F.count(F.lit(1)).alias("eventos"), F.countDistinct(user_col).alias("usuarios"),
                     F.sum(F.col(value_col).cast("decimal(38,9)")).alias("valor_total")))
        (kpis.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(out))

    run_available(s, out, ck, foreach=upsert)
    kpis = spark.read.parquet(out) if path_exists(spark, out) else spark.createDataFrame(
        [], "janela struct<start: timestamp, end: timestamp>, eventos long, usuarios long, valor_total decimal(38,9)")
    return kpis.select(
        F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "eventos", "usuarios",
        F.col("valor_total").cast("double").alias("valor_total"))


#: log2 of the registers of a window's sketch of users: relative error about 1.04 / sqrt(2 ** 14), 0.8 %.
SKETCH_LG = 14


def window_parts(events: DataFrame, time_col: str, user_col: str, value_col: str, window_hours: int) -> DataFrame:
    """Mergeable state of tumbling windows: events, sum, HyperLogLog sketch of users."""
    return events.groupBy(F.window(F.col(time_col).cast("timestamp"), f"{window_hours} hours").alias("janela")).agg(
        F.count(F.lit(1)).alias("eventos"), F.sum(F.col(value_col).cast("decimal(38,9)")).alias("valor_total"),
        F.hll_sketch_agg(user_col, SKETCH_LG).alias("usuarios"))


def merge_windows(parts: DataFrame) -> DataFrame:
    """The windows of several partial states (of batches, or merged ones again)."""
    return parts.groupBy("janela").agg(F.sum("eventos").alias("eventos"), F.sum("valor_total").alias("valor_total"),
                                       F.hll_union_agg("usuarios").alias("usuarios"))


def stream_kpis_merged(spark: SparkSession, folder: str, schema: StructType, glob: str, key: str, time_col: str,
                       user_col: str, value_col: str, window_hours: int = 3, max_files: int | None = None) -> DataFrame:
    """STR-5 with mergeable state: a micro-batch stores its new events and the partial
    windows of those alone; no stored event is read again. Counts and sums are exact,
    distinct users estimated from merged sketches (``SKETCH_LG``). Batches run exactly
    once, late events and events sent again included."""
    s = file_stream(spark, folder, schema, glob, max_files).withColumn(DAY, F.to_date(time_col))
    store, out, ck = (scratch_path(spark, f"stream_merged_{x}") for x in ("store", "out", "ck"))

    def add(batch: DataFrame, batch_id: int) -> None:
        lot = lots.lot_name(ck, batch_id)
        added = lots.append_once(batch, store, key, lot, DAY).where(F.col(time_col).isNotNull())
        lots.write_lot(window_parts(added, time_col, user_col, value_col, window_hours), out, lot)

    run_available(s, out, ck, foreach=add)
    done = lots.committed(spark, out)
    parts = lots.read_lots(spark, out, done) if done else window_parts(
        spark.createDataFrame([], s.schema), time_col, user_col, value_col, window_hours)
    return merge_windows(parts).select(
        F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "eventos",
        F.hll_sketch_estimate("usuarios").alias("usuarios"), F.col("valor_total").cast("double").alias("valor_total"))


def stream_invoice_load(spark: SparkSession, docs_folder: str, docs_schema: StructType, as_of: str,
                        store_path: str, checkpoint: str, max_files: int | None = None,
                        quarantine: str | None = None, salvage: bool = False) -> DataFrame:
    """STR-2/STR-4 for invoices: landed XML response documents are read as a
    file stream, parsed per micro-batch and appended with insert-if-absent
    (hash de-dup inside the batch, left-anti against the store across
    batches and replays); documents that do not parse go to the ``quarantine``
    path (``salvage``: their whole notes are kept). No watermark, so no late note is dropped; the same
    checkpoint serves the backfill and later incremental runs."""
    from ..sources import xml as xml_source

    stream = file_stream(spark, docs_folder, docs_schema, max_files=max_files)

    def batch(df: DataFrame, batch_id: int) -> None:
        # Each document is read once; what is kept of it is its notes, and its text if it is bad.
        scanned = xml_source.scan_responses(df)
        text = F.when(F.col("_corrupt_record").isNotNull(), F.col("xml")).alias("xml")
        kept = [text if c == "xml" else F.col(c) for c in df.columns] if quarantine else []
        scanned = scanned.select(*kept, "notas", "_corrupt_record").persist()
        notes = xml_source.notes_of(scanned, as_of, salvage=salvage).select("*", loading.issue_month())
        loading.append_new(notes, store_path, "hash_nfse", loading.MONTH)
        if quarantine:
            bad = scanned.where(F.col("_corrupt_record").isNotNull()).drop("notas")
            lots.write_lot(bad, quarantine, lots.lot_name(checkpoint, batch_id))
        scanned.unpersist()

    run_available(stream, store_path, checkpoint, foreach=batch)
    return spark.read.parquet(store_path).drop(loading.MONTH)
