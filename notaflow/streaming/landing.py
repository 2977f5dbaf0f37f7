"""Landing-folder ingestion as a file stream (SNK-10, SNK-11, SNK-14, STR-2, STR-3).

New workbooks are picked up by a ``binaryFile`` stream; each micro-batch is
decoded, cleaned and appended to the 15-column flexible raw table, partitioned by
ingestion date and file type, and the source files are archived by the stream
itself (``cleanSource=archive``) once the batch that read them is committed.
Every file leaves a ledger row, bad ones with their error. Rows and ledger are
written exactly once (``sinks/lots.py``): a batch that failed half way runs again in
place of its first attempt. Replay (the reference moves archived files back) is a
fresh checkpoint over the archive folder; the key index leaves out rows and files
that are stored already, without reading the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import clean_digits, lenient_date, parse_float, strip_ws
from ..functions.text import classify_file
from ..operators import cleaning
from ..operators.common import settle
from ..sinks import lots
from ..sinks.tables import stamp_raw_defaults
from ..sources import drops, files

#: Where extracted fields stand in a document, by settled column name; first hit wins.
EXTRACT_CNPJ = ("cnpj", "CNPJ")
EXTRACT_DATE = ("data_emissao", "Data_Emissao", "data", "Data")
EXTRACT_VALUE = ("valor_liquido", "Valor_Liquido_R$", "Liquido", "valor", "Valor")
EXTRACT_CLIENT = ("cliente", "Cliente", "razao_social", "Razao_Social")

RAW_COLS = ("arquivo_nome", "arquivo_tipo", "aba_nome", "dados_json", "cnpj", "data_emissao", "valor", "cliente",
            "linha_original", "hash_linha", "_ingestion_timestamp", "_ingestion_batch_id", "_source_bucket",
            "_processing_status", "_processing_error")
ROW_KEY = ["arquivo_nome", "aba_nome", "linha_original", "hash_linha"]
FILE_KEY = ["arquivo_nome", "arquivo_hash"]
INGESTION_DATE = "_ingestion_date"
_KEY = "_chave"


def raw_rows(cells: DataFrame, batch_id: str) -> DataFrame:
    """The flexible raw rows of decoded cells, with fields extracted where a column
    holds them (CLN-10/11 stamps: ingestion time, batch, bucket, type)."""
    doc = F.from_json("dados_json", "map<string,string>")

    def first(keys: tuple[str, ...]) -> Column:
        values = [F.nullif(strip_ws(F.try_element_at(F.col("__d"), F.lit(k))), F.lit("")) for k in keys]
        return F.coalesce(*values)

    docs = settle(cleaning.documents(cells))
    rows = docs.withColumn("__d", F.explode(F.array(doc)))  # parsed once, each text taken once
    rows = settle(rows.select(*docs.columns, first(EXTRACT_CNPJ).alias("__cnpj"), first(EXTRACT_DATE).alias("__data"),
                              first(EXTRACT_VALUE).alias("__valor"), first(EXTRACT_CLIENT).alias("cliente")))
    rows = rows.select(
        "*", F.nullif(clean_digits("__cnpj"), F.lit("")).alias("cnpj"),
        lenient_date("__data").alias("data_emissao"), parse_float("__valor").alias("valor"),
        F.lit(batch_id).alias("_ingestion_batch_id"),
        F.lit(None).cast("string").alias("_processing_error"))
    return stamp_raw_defaults(rows).select(*RAW_COLS)


def ledger_rows(workbooks: DataFrame, cells: DataFrame) -> DataFrame:
    """SNK-14: one row per file: hash, bytes, modified time, sheets, data rows, type,
    status ('processado', 'vazio' or 'erro') and the error, sheet errors included."""
    data = F.when(F.col("linha") > 0, F.struct("aba_nome", "linha"))
    per_row = cells.groupBy("arquivo_nome", "aba_nome", "linha").agg(F.max("erro").alias("erro"))
    found = per_row.groupBy("arquivo_nome").agg(
        F.count(data).alias("total_linhas"), F.size(F.collect_set("aba_nome")).cast("long").alias("total_abas"),
        F.max("erro").alias("erro_mensagem"),
        F.max(F.col("erro").isNotNull() & F.col("aba_nome").isNull()).alias("__ruim"))
    rows = F.coalesce("total_linhas", F.lit(0))
    return (workbooks.select("arquivo_nome", F.sha2("content", 256).alias("arquivo_hash"),
                             F.length("content").cast("long").alias("tamanho_bytes"), "data_modificacao")
            .join(found, "arquivo_nome", "left")
            .select("arquivo_nome", "arquivo_hash", "tamanho_bytes", "data_modificacao",
                    F.coalesce("total_abas", F.lit(0)).alias("total_abas"), rows.alias("total_linhas"),
                    F.when(F.coalesce("__ruim", F.lit(False)), F.lit(C.TYPE_ERROR))
                    .otherwise(classify_file(F.col("arquivo_nome"))).alias("tipo_arquivo"),
                    F.when(F.coalesce("__ruim", F.lit(False)), F.lit("erro"))
                    .when(rows > 0, F.lit("processado")).otherwise(F.lit("vazio")).alias("status"),
                    "erro_mensagem"))


def _keyed(rows: DataFrame, cols: list[str]) -> DataFrame:
    return rows.withColumn(_KEY, F.sha2(F.to_json(F.struct(*cols)), 256))


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The raw table or the ledger that the stream has written."""
    return lots.read_store(spark, path).drop(_KEY)


def store_cells(cells: DataFrame, raw_path: str, lot: str, batch_id: str) -> None:
    """The good cells' rows into the raw table, once each."""
    rows = raw_rows(cells.filter(F.col("erro").isNull()).drop("erro"), batch_id)
    rows = rows.withColumn(INGESTION_DATE, F.to_date("_ingestion_timestamp"))
    lots.append_once(_keyed(rows, ROW_KEY), raw_path, _KEY, lot, INGESTION_DATE, "arquivo_tipo",
                     sort_by=("cnpj", "data_emissao"))


def ingest_text_stream(lines: DataFrame, kind: str, raw_path: str, checkpoint: str, bad_path: str | None = None) -> None:
    """Drain a stream of text lines (``drops.text_lines``) of CSV or JSON-lines files (``kind``:
    'csv', 'jsonl') into the raw table that workbooks go to; bad lines to ``bad_path``."""

    def batch(df: DataFrame, batch_id: int) -> None:
        lot = lots.lot_name(checkpoint, batch_id)
        cells = drops.READERS[kind](df).persist()
        store_cells(cells, raw_path, lot, f"lote-{batch_id}")
        if bad_path:
            bad = cells.where(F.col("erro").isNotNull()).select("arquivo_nome", "linha", F.col("valor").alias("texto"), "erro")
            lots.write_lot(bad, bad_path, lot)
        cells.unpersist()

    (lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
     .trigger(availableNow=True).start().awaitTermination())


def ingest_stream(stream: DataFrame, raw_path: str, checkpoint: str, ledger_path: str | None = None) -> None:
    """Drain a stream of workbooks (arquivo_nome, content, data_modificacao) now."""

    def batch(df: DataFrame, batch_id: int) -> None:
        lot = lots.lot_name(checkpoint, batch_id)
        # A workbook is read by one task; those of a file of many are dealt out first.
        cells = files.decode_workbooks(df.repartition(df.sparkSession.sparkContext.defaultParallelism)).persist()
        store_cells(cells, raw_path, lot, f"lote-{batch_id}")
        if ledger_path:
            lots.append_once(_keyed(ledger_rows(df, cells), FILE_KEY), ledger_path, _KEY, lot)
        cells.unpersist()

    (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
     .trigger(availableNow=True).start().awaitTermination())


def ingest_landing(spark: SparkSession, landing: str, raw_path: str, checkpoint: str,
                   archive: str | None = None, glob: str = "*.xlsx", ledger_path: str | None = None) -> None:
    """Drain the landing folder now (``availableNow``): decode, append raw
    documents, archive processed files when ``archive`` is given."""
    r = (spark.readStream.format("binaryFile")
         .schema("path string, modificationTime timestamp, length bigint, content binary")
         .option("pathGlobFilter", glob))
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    stream = r.load(landing).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo_nome"), "content",
                                    F.col("modificationTime").alias("data_modificacao"))
    ingest_stream(stream, raw_path, checkpoint, ledger_path)


def pending_files(spark: SparkSession, landing: str, ledger: DataFrame, glob: str = "*.xlsx") -> DataFrame:
    """Batch equivalent: files in the landing folder not in the processed ledger."""
    listed = files.list_files(spark, landing, glob)
    return listed.join(ledger.select("arquivo_nome"), "arquivo_nome", "left_anti")
