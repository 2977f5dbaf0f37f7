"""Spreadsheet path on a long cells table (CLN-*, UNI-1, ALN-1, COE-*, SNK-2/3/14).

Cells are ``(arquivo_nome, aba_nome, linha, coluna, valor)``; row 0 holds the
headers. Headers are metadata (one row per sheet column) and cells are data:
cells stay long until headers are settled, then each row becomes one
document (SNK-2) or one typed wide row per target (ALN-1 + COE-*), pivoted
with an explicit column list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import blank_to_null, lenient_date, lenient_timestamp, parse_float, round_half_away, strip_ws
from ..functions.text import classify_file, clean_cell, normalize_header
from .common import settle

SHEET = ("arquivo_nome", "aba_nome")
ROW = ("arquivo_nome", "aba_nome", "linha")


def headers(cells: DataFrame) -> DataFrame:
    """Header table: one row per (file, sheet, column) with raw and normalised name."""
    h = cells.filter(F.col("linha") == 0).select(*SHEET, "coluna", F.col("valor").alias("cabecalho"))
    return h.withColumn("nome", normalize_header(F.col("cabecalho"), F.col("coluna")))


def data_cells(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("linha") > 0)


def filled_rows(cells: DataFrame) -> DataFrame:
    """CLN-3: one row per data row with at least one non-null cell, holding its cells."""
    g = data_cells(cells).groupBy(*ROW).agg(F.collect_list(F.struct("coluna", "valor")).alias("__cells"),
                                            F.count("valor").alias("__n"))
    return g.filter(F.col("__n") > 0).drop("__n")


def sheet_columns(cells: DataFrame) -> DataFrame:
    """CLN-4: per (file, sheet, column) the header and the number of non-null data
    cells, in one aggregate; columns without a header cell are left out."""
    is_header = F.col("linha") == 0
    g = cells.groupBy(*SHEET, "coluna").agg(F.max(is_header).alias("__h"), F.max(F.when(is_header, F.col("valor"))).alias("cabecalho"),
                                            F.count(F.when(~is_header, F.col("valor"))).alias("celulas"))
    return g.filter("__h").drop("__h")


def dedupe_headers(hdr: DataFrame) -> DataFrame:
    """CLN-5: the 2nd, 3rd... column with the same name in a sheet gets _1, _2.
    A generated name can collide with a real one (``A``, ``A``, ``A_1``), so the
    pass repeats until the sheet's names are unique. Headers are metadata: a
    sheet's names (at most one per column) are one array."""
    def suffixed(names: Column) -> Column:
        def name(n: Column, i: Column) -> Column:
            k = F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == n))
            return F.when(k > 0, F.concat(n, F.lit("_"), k.cast("string"))).otherwise(n)
        return F.transform(names, name)

    def settle_names(names: Column, _: Column) -> Column:
        return F.when(F.size(F.array_distinct(names)) == F.size(names), names).otherwise(suffixed(names))

    others = [c for c in hdr.columns if c not in (*SHEET, "nome")]
    sheets = hdr.groupBy(*SHEET).agg(F.array_sort(F.collect_list(F.struct("coluna", *[c for c in others if c != "coluna"],
                                                                          "nome"))).alias("__c"))
    # One pass per column at most: each pass settles at least one more name.
    names = F.aggregate(F.sequence(F.lit(1), F.size("__c")), F.col("__c.nome"), settle_names)
    out = sheets.select(*SHEET, F.explode(F.arrays_zip(F.col("__c").alias("c"), names.alias("n"))).alias("__z"))
    return out.select(*[F.col("__z.n").alias(c) if c == "nome" else F.col(c) if c in SHEET else F.col(f"__z.c.{c}").alias(c)
                        for c in hdr.columns])


def settled_headers(cells: DataFrame) -> DataFrame:
    """Normalise, drop all-empty columns, then de-duplicate (reference order)."""
    hdr = sheet_columns(cells).filter(F.col("celulas") > 0).drop("celulas")
    return dedupe_headers(hdr.withColumn("nome", normalize_header(F.col("cabecalho"), F.col("coluna"))))


def named_rows(cells: DataFrame) -> DataFrame:
    """Filled rows beside their sheet's settled names (``__nomes``: column -> name). Two
    scans: one for the names (one row per sheet), one for the rows."""
    names = settled_headers(cells).groupBy(*SHEET).agg(
        F.map_from_entries(F.collect_list(F.struct("coluna", "nome"))).alias("__nomes"))
    return filled_rows(cells).join(names, list(SHEET))


def clean_cells(cells: DataFrame) -> DataFrame:
    """Cleaned long data: empty rows and columns gone, values cleaned
    (CLN-3..9), keyed by the settled column name. Only cells present in the
    source are kept; an absent cell means '' (pandas' NaN -> ''), which
    ``documents`` fills in from the sheet's column list."""
    long = named_rows(cells).select(*ROW, "__nomes", F.explode("__cells").alias("__c"))
    long = long.select(*ROW, F.col("__c.coluna").alias("coluna"),
                       F.try_element_at("__nomes", F.col("__c.coluna")).alias("coluna_nome"),
                       F.col("__c.valor").alias("__v"))
    return long.filter(F.col("coluna_nome").isNotNull()).select(
        *ROW, "coluna", "coluna_nome", clean_cell(F.col("__v")).alias("valor"))


def stamp(df: DataFrame, as_of: str, client_name: str = "", origin: str = "google_drive") -> DataFrame:
    """CLN-10/11: client name, processing date, origin; file type from the name."""
    return df.select("*", F.lit(client_name).alias("cliente_nome"),
                     F.lit(as_of).cast("date").alias("data_processamento"),
                     F.lit(origin).alias("origem_arquivo"),
                     classify_file(F.col("arquivo_nome")).alias("tipo_arquivo"))


def documents(cells: DataFrame) -> DataFrame:
    """UNI-1 + SNK-2: one flexible document per source row, every column of
    its sheet present ('' when the cell was empty), keys sorted; routed by
    type (SNK-3). Stacking sheets by column name is implicit in the long
    form. The per-sheet name list is one row per sheet (metadata)."""
    g = named_rows(cells)
    known = F.filter("__cells", lambda c: F.map_contains_key(F.col("__nomes"), c["coluna"]))
    value = F.map_from_entries(F.transform(known, lambda c: F.struct(F.element_at(F.col("__nomes"), c["coluna"]), c["valor"])))
    g = g.select(*ROW, F.array_sort(F.map_values("__nomes")).alias("__lista"), value.alias("__m"))
    full = F.map_from_arrays(F.col("__lista"), F.transform(
        F.col("__lista"), lambda n: clean_cell(F.try_element_at(F.col("__m"), n))))
    g = g.withColumn("dados_json", F.to_json(full))
    tipo = classify_file(F.col("arquivo_nome"))
    return g.select(
        "arquivo_nome", tipo.alias("arquivo_tipo"), "aba_nome", "dados_json",
        F.col("linha").cast("bigint").alias("linha_original"),
        F.sha2(F.col("dados_json"), 256).alias("hash_linha"),
        F.lit(C.STATUS_PROCESSED).alias("_processing_status"),
        route_table(tipo).alias("tabela_destino"))


def route_table(tipo: Column) -> Column:
    """SNK-3: target table per file type, default generic."""
    e = None
    for t, table in C.TABLE_BY_TYPE.items():
        e = F.when(tipo == t, F.lit(table)) if e is None else e.when(tipo == t, F.lit(table))
    return e.otherwise(F.lit(C.TABLE_DEFAULT))


def column_match(source_names: DataFrame, target: DataFrame) -> DataFrame:
    """ALN-1: per target column, the first source column (by ``ordem``) whose
    name matches case-insensitively, or after lower + '_'->' ' (º/ª removed on
    the source side only). Two equi-joins on normalised keys, no pair scan."""
    s = source_names.select(
        "ordem", F.col("nome").alias("coluna_origem"),
        F.lower("nome").alias("k1"),
        F.translate(F.replace(F.lower("nome"), F.lit("_"), F.lit(" ")), "ºª", "").alias("k2"))
    t = target.select("tabela", "coluna_destino", "tipo",
                      F.lower("coluna_destino").alias("k1"),
                      F.replace(F.lower("coluna_destino"), F.lit("_"), F.lit(" ")).alias("k2"))
    m1 = t.join(s.select("ordem", "coluna_origem", "k1"), "k1")
    m2 = t.join(s.select("ordem", "coluna_origem", "k2"), "k2")
    cols = ["tabela", "coluna_destino", "tipo", "ordem", "coluna_origem"]
    both = m1.select(*cols).unionByName(m2.select(*cols))
    best = both.groupBy("tabela", "coluna_destino", "tipo").agg(
        F.min(F.struct("ordem", "coluna_origem")).alias("m"))
    return (t.select("tabela", "coluna_destino", "tipo")
            .join(best, ["tabela", "coluna_destino", "tipo"], "left")
            .select("tabela", "coluna_destino", "tipo", F.col("m.coluna_origem").alias("coluna_origem")))


def coerce(value: Column, bq_type: str, string_limit: int | None = C.STRING_CELL_LIMIT) -> Column:
    """COE-1..6: typed value from cleaned text; bad -> NULL. Text longer than
    ``string_limit`` (the reference's rule; None: whole) is cut; ``cut_cells``
    counts such cells."""
    v = blank_to_null(value)
    t = bq_type.upper()
    if t == "STRING":
        return F.substring(strip_ws(v), 1, string_limit) if string_limit else strip_ws(v)
    if t in ("FLOAT", "FLOAT64", "NUMERIC"):
        return parse_float(v)
    if t == "DATE":
        return lenient_date(v)
    if t == "DATETIME":
        return lenient_timestamp(v)
    return v.cast("string")


def cut_cells(clean: DataFrame, string_limit: int = C.STRING_CELL_LIMIT) -> DataFrame:
    """RPT-1: per file, cells whose text a typed load would cut."""
    return (clean.filter(F.length(strip_ws(F.col("valor"))) > string_limit)
            .groupBy("arquivo_nome").agg(F.count(F.lit(1)).alias("celulas_cortadas")))


def typed_rows(clean: DataFrame, mapping: Sequence[tuple[str, str, str | None]],
               with_errors: bool = False) -> DataFrame:
    """ALN-1 + COE-*: wide typed rows. ``mapping`` = (target, type, source or
    None); a target without source is NULL (COE-7). The pivot uses an explicit
    column list, so it is one aggregation with partial combine."""
    sources = sorted({s for _, _, s in mapping if s})
    # One aggregation per row over all its cells: rows without any mapped
    # source column still come out (all NULL), with no extra distinct/join.
    picks = [F.max(F.when(F.col("coluna_nome") == src, F.col("valor"))).alias(src) for src in sources]
    rows = clean.groupBy(*ROW).agg(*(picks or [F.count(F.lit(1)).alias("__n")]))
    out: list[Column] = [F.col(c) for c in ROW]
    errors = F.lit(0)
    for target, bq_type, source in mapping:
        empty = {"STRING": "string", "FLOAT": "double", "DATE": "date", "DATETIME": "timestamp"}
        e = coerce(F.col(source), bq_type) if source else F.lit(None).cast(empty.get(bq_type.upper(), "string"))
        out.append(e.alias(target))
        if source:
            errors = errors + F.when(blank_to_null(F.col(source)).isNotNull() & e.isNull(), 1).otherwise(0)
    res = rows.select(*out, errors.alias("__erros"))
    return res if with_errors else res.drop("__erros")


def empty_report(cells: DataFrame) -> DataFrame:
    """CLN-3/4 report per sheet: data rows and columns, and how many were empty."""
    d = data_cells(cells)
    rows = d.groupBy(*ROW).agg(F.count("valor").alias("n"))
    r = rows.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("linhas"),
                                 F.count(F.when(F.col("n") == 0, 1)).alias("linhas_vazias"))
    cols = headers(cells).select(*SHEET, "coluna").join(
        d.groupBy(*SHEET, "coluna").agg(F.count("valor").alias("n")), [*SHEET, "coluna"], "left")
    c = cols.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("colunas"),
                                 F.count(F.when(F.coalesce(F.col("n"), F.lit(0)) == 0, 1)).alias("colunas_vazias"))
    return r.join(c, list(SHEET), "full_outer")


def file_profile(cells: DataFrame, date_column: str | None = None) -> DataFrame:
    """SNK-14: per file: sheets (count, sorted names), data rows, detected
    columns (sorted), type, period (min/max of a date column), status."""
    per_file_cols = settled_headers(cells).groupBy("arquivo_nome").agg(
        F.array_sort(F.collect_set("nome")).alias("colunas_detectadas"),
        F.countDistinct("aba_nome").alias("total_abas"),
        F.array_sort(F.collect_set("aba_nome")).alias("abas_nomes"))
    rows = named_rows(cells) if date_column else filled_rows(cells)
    aggs = [F.count(F.lit(1)).alias("total_linhas")]
    if date_column:
        here = F.filter("__cells", lambda c: F.try_element_at(F.col("__nomes"), c["coluna"]) == F.lit(date_column))
        day = lenient_date(clean_cell(F.get(here, 0)["valor"]))
        rows = settle(rows.select("arquivo_nome", day.alias("__dia")))
        aggs += [F.min("__dia").alias("periodo_inicio"), F.max("__dia").alias("periodo_fim")]
    out = per_file_cols.join(rows.groupBy("arquivo_nome").agg(*aggs), "arquivo_nome", "left")
    return out.select("arquivo_nome", "total_abas", "abas_nomes",
                      F.coalesce("total_linhas", F.lit(0)).alias("total_linhas"), "colunas_detectadas",
                      classify_file(F.col("arquivo_nome")).alias("tipo_arquivo"),
                      *([ "periodo_inicio", "periodo_fim"] if date_column else []),
                      F.when(F.coalesce("total_linhas", F.lit(0)) > 0, F.lit("processado"))
                      .otherwise(F.lit("vazio")).alias("status"))


def load_typed(typed: DataFrame, path: str, quarantine: str, lot: str | None = None) -> dict:
    """SNK-1 + RPT-1: append typed rows; rows with a value that failed its
    type go to a quarantine table instead. Counts come from ``observe``
    (gathered while writing, no extra pass). Needs ``typed_rows(...,
    with_errors=True)``. With ``lot`` both outputs are written under that name: a load that
    runs again replaces its own rows (read the tables with ``lots.read_store``)."""
    from pyspark.sql import Observation

    from ..sinks import lots
    ok_obs, bad_obs = Observation("inseridas"), Observation("erros")
    typed = typed.checkpoint()  # coerce once, then split good / bad rows
    good = typed.filter(F.col("__erros") == 0).drop("__erros").observe(ok_obs, F.count(F.lit(1)).alias("n"))
    bad = typed.filter(F.col("__erros") > 0)
    bad = (bad.withColumnRenamed("__erros", "valores_invalidos") if lot else bad).observe(bad_obs, F.count(F.lit(1)).alias("n"))
    if lot:
        lots.write_lot(good, f"{path}/dados", lot)
        lots.write_lot(bad, f"{quarantine}/dados", lot)
    else:
        good.write.mode("append").parquet(path)
        bad.write.mode("append").parquet(quarantine)
    inserted, errors = ok_obs.get["n"], bad_obs.get["n"]
    total = inserted + errors
    return {"linhas": total, "inseridas": inserted, "erros": errors,
            "taxa_sucesso_pct": round(inserted * 100.0 / total, 1) if total else 0.0}


def typed_load_report(good: DataFrame, bad: DataFrame) -> DataFrame:
    """RPT-1 by file over the two tables of a typed load: rows, those stored, those kept
    back, values that failed their type, and the share stored in percent."""
    rows = good.select("arquivo_nome", F.lit(0).alias("__e")).unionByName(
        bad.select("arquivo_nome", F.col("valores_invalidos").alias("__e")))
    g = rows.groupBy("arquivo_nome").agg(
        F.count(F.lit(1)).alias("linhas"), F.count(F.when(F.col("__e") == 0, 1)).alias("inseridas"),
        F.count(F.when(F.col("__e") > 0, 1)).alias("erros"), F.sum("__e").alias("valores_invalidos"))
    return g.withColumn("taxa_sucesso_pct", round_half_away(F.col("inseridas").cast("double") * 100 / F.col("linhas"), 1))
