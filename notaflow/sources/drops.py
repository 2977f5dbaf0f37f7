"""Landed CSV and JSON-lines files (SRC-3) as the long cells that workbooks give.

Files are read as text, split over tasks inside a file, and every line gets its number
in the file: lines are counted per block of a file, and a block's offset is the sum of
the blocks before it (one row per block). Row 0 holds the headers; files whose headers
differ meet later, when columns are stacked by settled name. A line that does not parse
is no cell but a row with its number, its text and the reason in ``erro``, so nothing is
lost and ``erro IS NULL`` gives the good ones. Blank lines are no rows. Text is UTF-8; a
quoted field that runs over a line end is two bad lines. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from ..operators.common import settle

#: The sheet name of files that have no sheets.
SHEET = "dados"
SEPARATORS = (";", ",", "\t", "|")
BAD_QUOTES, TOO_MANY, BAD_HEADER, NO_OBJECT = "aspas sem par", "campos demais", "cabecalho ilegivel", "linha sem objeto JSON"


def text_lines(spark: SparkSession | DataStreamReader, folder: str, glob: str = "*") -> DataFrame:
    """(arquivo_nome, caminho, bloco, texto) of the folder's text files. ``spark``: a
    session, or its ``readStream``. A partition column ``arquivo_nome`` gives the file's name, else its
    path does."""
    reader = spark.read if isinstance(spark, SparkSession) else spark
    lines = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "false").format("text").load(folder)
    # Paths are addresses: a space is %20 there, and a plus a plus.
    last = F.replace(F.regexp_extract("_metadata.file_path", "([^/]+)$", 1), F.lit("+"), F.lit("%2B"))
    name = F.col("arquivo_nome") if "arquivo_nome" in lines.columns else F.url_decode(last)
    return lines.select(name.alias("arquivo_nome"), F.col("_metadata.file_path").alias("caminho"),
                        F.col("_metadata.file_block_start").alias("bloco"), F.col("value").alias("texto"))


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` that are not blank with ``linha``, their number in the file from 0."""
    rows = lines.where(F.trim("texto") != "").withColumn("__i", F.monotonically_increasing_id())
    blocks = rows.groupBy("caminho", "bloco").agg(F.min("__i").alias("__primeira"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("caminho").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__antes", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    # A task reads a block's lines one after another, so they have consecutive numbers.
    return rows.join(blocks, ["caminho", "bloco"]).select(
        "arquivo_nome", "caminho", (F.col("__antes") + F.col("__i") - F.col("__primeira")).alias("linha"), "texto")


def _fields(sep: str) -> Column:
    """The fields of ``texto`` as they stand, each with a separator before it."""
    s = "\\" + sep if sep == "|" else sep
    field = f'{s}(?:"[^"]*+(?:""[^"]*+)*+"|(?:[^"{s}][^{s}]*+)?+)'
    return F.regexp_extract_all(F.concat(F.lit(sep), "texto"), F.lit(field), F.lit(0))


def _split(separator: Column) -> Column:
    """The line's values and whether they make up the whole line."""
    found = F.when(separator == SEPARATORS[0], _fields(SEPARATORS[0]))
    for sep in SEPARATORS[1:]:
        found = found.when(separator == sep, _fields(sep))

    def value(m: Column) -> Column:
        v = F.substring(m, 2, 2147483646)
        inner = F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(F.startswith(v, F.lit('"')), inner).otherwise(v), F.lit(""))

    whole = F.array_join(found, "") == F.concat(separator, F.col("texto"))
    return F.struct(F.transform(found, value).alias("valores"), whole.alias("inteira"))


def _separator() -> Column:
    """The separator that a header holds most of outside quotes (the first of equals)."""
    bare = F.regexp_replace("texto", '"[^"]*"', "")
    counts = [F.struct((F.length(bare) - F.length(F.replace(bare, F.lit(s), F.lit("")))).alias("n"),
                       F.lit(-i).alias("i"), F.lit(s).alias("s")) for i, s in enumerate(SEPARATORS)]
    return F.greatest(*counts)["s"]


def _cells(rows: DataFrame, column: str, value: str) -> DataFrame:
    return rows.select("arquivo_nome", F.lit(SHEET).alias("aba_nome"), F.col("linha").cast("bigint").alias("linha"),
                       F.col(column).cast("int").alias("coluna"), F.col(value).cast("string").alias("valor"),
                       F.lit(None).cast("string").alias("erro"))


def _bad(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.select("arquivo_nome", F.lit(SHEET).alias("aba_nome"), F.col("linha").cast("bigint").alias("linha"),
                       F.lit(None).cast("int").alias("coluna"), F.col("texto").alias("valor"), reason.alias("erro"))


def csv_cells(lines: DataFrame) -> DataFrame:
    """CSV lines -> cells; the separator is found per file. A row of fewer fields than the
    header has empty cells; one of more is bad. A file whose header does not parse gives
    one row with ``erro`` and no sheet, as a workbook that does not open."""
    rows = numbered(lines)
    rows = rows.withColumn("texto", F.when(F.col("linha") == 0, F.regexp_replace("texto", "^﻿", "")).otherwise(F.col("texto")))
    head = rows.where("linha = 0").select("caminho", "texto", _separator().alias("__sep"))
    head = settle(head.withColumn("__c", _split(F.col("__sep")))).select(
        "caminho", "__sep", F.size("__c.valores").alias("__colunas"), F.col("__c.inteira").alias("__legivel"))
    rows = settle(rows.join(head, "caminho").withColumn("__c", _split(F.col("__sep"))))
    ok = F.col("__legivel") & F.col("__c.inteira") & (F.size("__c.valores") <= F.col("__colunas"))
    reason = F.when(~F.col("__c.inteira"), F.lit(BAD_QUOTES)).otherwise(F.lit(TOO_MANY))
    cells = rows.where(ok).select("arquivo_nome", "linha", F.posexplode("__c.valores").alias("coluna", "valor"))
    cells = cells.where((F.col("linha") == 0) | F.col("valor").isNotNull())
    bad = _bad(rows.where(F.col("__legivel") & ~ok), reason)
    unread = rows.where(~F.col("__legivel") & (F.col("linha") == 0))
    unread = _bad(unread, F.lit(BAD_HEADER)).withColumns({"aba_nome": F.lit(None).cast("string"), "linha": F.lit(None).cast("bigint")})
    return _cells(cells, "coluna", "valor").unionByName(bad).unionByName(unread)


def jsonl_cells(lines: DataFrame) -> DataFrame:
    """JSON-lines -> cells: one object per line is one row (the first is row 1), its keys
    are headers in the order of their first appearance in the file, nested values stay JSON text,
    numbers are printed as Spark reads them (1.50 is 1.5). A key that stands twice in an object has its first value. Lines that hold no object are bad."""
    rows = numbered(lines).withColumn("linha", F.col("linha") + 1)
    rows = settle(rows.withColumn("__d", F.from_json("texto", "map<string,string>")))
    good = rows.where(F.col("__d").isNotNull())
    keys = good.select("arquivo_nome", "caminho", "linha", F.posexplode(F.array_distinct(F.map_keys("__d"))).alias("__p", "nome"))
    first = keys.groupBy("arquivo_nome", "caminho", "nome").agg(F.min(F.struct("linha", "__p")).alias("__onde"))
    # One row per key of a file (metadata).
    order = Window.partitionBy("caminho").orderBy("__onde")
    heads = first.select("arquivo_nome", "caminho", "nome", (F.row_number().over(order) - 1).alias("coluna"), F.lit(0).alias("linha"))
    places = heads.groupBy("caminho").agg(F.map_from_entries(F.collect_list(F.struct("nome", "coluna"))).alias("__onde"))
    pairs = F.transform(F.array_distinct(F.map_keys("__d")), lambda k: F.struct(
        F.element_at("__onde", k).alias("coluna"), F.element_at("__d", k).alias("valor")))
    cells = good.join(places, "caminho").select("arquivo_nome", "linha", F.explode(pairs).alias("__c")).select(
        "arquivo_nome", "linha", "__c.coluna", "__c.valor").where(F.col("valor").isNotNull())
    return (_cells(heads, "coluna", "nome").unionByName(_cells(cells, "coluna", "valor"))
            .unionByName(_bad(rows.where(F.col("__d").isNull()), F.lit(NO_OBJECT))))


READERS = {"csv": csv_cells, "jsonl": jsonl_cells}
