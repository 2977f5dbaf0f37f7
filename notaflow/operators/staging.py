"""Staging normalisation: flexible raw documents -> typed rows (STG-1..13).

The document is parsed once per row into ``map<string,string>`` (see
``with_document``), then every field is a first-non-null over candidate keys. A raw
table that was written with a Variant column is not parsed again: fields are looked up
in it, and the text isn't read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import clean_digits, document_scalars, document_value, safe_iso_date, serial_date, variant_value
from .common import settle

DOC = "__doc"
_DOUBLE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def with_document(raw: DataFrame) -> DataFrame:
    """Parse the document once per row.

    The parse sits in a one-element ``explode`` (a Generate node): predicates
    over the parsed fields are not pushed below a Generate, so the optimizer
    cannot inline ``from_json`` into each filter term and re-parse the row."""
    return raw.select("*", F.explode(F.array(document_scalars("dados_json")))
                      .alias(DOC))


def documents(raw: DataFrame) -> tuple[DataFrame, Callable[[str], Column]]:
    """The rows and what looks a key up in their document."""
    if C.VARIANT_COLUMN in raw.columns:
        return raw, lambda key: variant_value(F.col(C.VARIANT_COLUMN), key)
    return with_document(raw), lambda key: document_value(F.col(DOC), key)


def _first(v: Callable[[str], Column], keys, tail: Column | None = None) -> Column:
    cols = [v(k) for k in keys]
    return F.coalesce(*(cols + ([tail] if tail is not None else [])))


def safe_double(c: Column) -> Column:
    """SAFE_CAST(x AS FLOAT64) of numeric text (Spark would also take '1.5d'); what is
    not a finite number, 'nan' and 'inf' included, is NULL: no sum survives it."""
    v = F.when(c.rlike(_DOUBLE), F.trim(c).try_cast("double"))
    return F.when(F.abs(v) < float("inf"), v)


def billing(raw: DataFrame, fallback_type: str = C.TYPE_FALLBACK) -> DataFrame:
    """``vw_faturamento_normalizado``. The type/status filter reaches the scan;
    the not-null filter applies to computed columns."""
    types = [t for t in C.BILLING_TYPES if t != C.TYPE_FALLBACK] + [fallback_type]
    r, _v = documents(raw.filter(F.col("arquivo_tipo").isin(*types)
                                 & (F.col("_processing_status") == C.STATUS_PROCESSED)))
    date = F.coalesce(*[safe_iso_date(_v(k)) for k in C.KEYS_DATE_ISO],
                      *[serial_date(_v(k)) for k in C.KEYS_DATE_SERIAL],
                      F.col("data_emissao"))
    cnpj = F.coalesce(*[clean_digits(_v(k)) for k in C.KEYS_CNPJ], clean_digits(F.col("cnpj")))
    out = r.select(
        "arquivo_nome", "aba_nome", "linha_original",
        _first(_v, C.KEYS_CLIENTE, F.col("cliente")).alias("cliente"),
        date.alias("data_emissao"),
        cnpj.alias("cnpj"),
        _first(_v, C.KEYS_NUMERO).alias("numero_nota"),
        F.coalesce(*[safe_double(_v(k)) for k in C.KEYS_LIQUIDO],
                   F.col("valor").cast("double")).alias("valor_liquido"),
        F.coalesce(*[safe_double(_v(k)) for k in C.KEYS_BRUTO]).alias("valor_bruto"),
        F.coalesce(*[safe_double(_v(k)) for k in C.KEYS_HONORARIOS]).alias("honorarios"),
        _v(C.KEY_TIPO).alias("tipo_servico"),
        _v(C.KEY_SITUACAO).alias("situacao"),
        _v(C.KEY_CONSULTOR).alias("consultor"),
        "_ingestion_timestamp", "_ingestion_batch_id")
    return settle(out).filter(F.col("cnpj").isNotNull() & F.col("data_emissao").isNotNull()
                               & F.col("valor_liquido").isNotNull())


def companies(raw: DataFrame, fallback_type: str = C.TYPE_FALLBACK) -> DataFrame:
    """``vw_empresas_normalizado``: cleaning happens after the coalesce (STG-10)."""
    types = [t for t in C.COMPANY_TYPES if t != C.TYPE_FALLBACK] + [fallback_type]
    r, _v = documents(raw.filter(F.col("arquivo_tipo").isin(*types)
                                 & (F.col("_processing_status") == C.STATUS_PROCESSED)))
    r = r.filter(_v("cnpj").isNotNull() | _v("CNPJ").isNotNull() | F.col("cnpj").isNotNull())
    return r.select(
        "arquivo_nome", "linha_original",
        clean_digits(F.coalesce(*[_v(k) for k in C.KEYS_CNPJ], F.col("cnpj"))).alias("cnpj"),
        _first(_v, C.KEYS_RAZAO).alias("razao_social"),
        _first(_v, C.KEYS_FANTASIA).alias("nome_fantasia"),
        _first(_v, C.KEYS_SITUACAO_CAD).alias("situacao_cadastral"),
        safe_iso_date(_first(_v, C.KEYS_DATA_SITUACAO)).alias("data_situacao"),
        _first(_v, C.KEYS_ENDERECO).alias("endereco"),
        "_ingestion_timestamp")
