"""Text rules of the spreadsheet path as column expressions (CLN-1, CLN-2, CLN-7..9)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import config as C
from .exprs import col, strip_ws

# FIXED VALUES — header character replacements, in the order they apply.
HEADER_REPLACEMENTS = (
    (".", "_"), ("º", "_num"), ("ª", "_a"), (" ", "_"), ("/", "_"), ("-", "_"),
    ("(", ""), (")", ""), ("&", "_e_"), ("%", "_pct"), ("#", "_num"), ("°", "_grau"),
)


def classify_file(name) -> Column:
    """CLN-1: file type from the lower-cased name; first rule that hits wins."""
    n = F.lower(col(name))
    years = "(" + "|".join(C.HISTORIC_YEARS) + ")"
    return (F.when(n.contains("faturamento") & n.rlike(years), F.lit(C.TYPE_HISTORIC_BILLING))
            .when(n.contains("empresas antigas"), F.lit(C.TYPE_OLD_COMPANIES))
            .when(n.contains("todos clientes"), F.lit(C.TYPE_CURRENT_CLIENTS))
            .otherwise(F.lit(C.TYPE_FALLBACK)))


def unaccented(text: Column) -> Column:
    """Unicode decomposition (NFD) without the marks that it sets apart, in any script. For
    headers, which are few: SQL has no such function."""

    def strip_marks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else "".join(
            c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn"))

    return F.pandas_udf(strip_marks, StringType())(text)


def normalize_header(header, index) -> Column:
    """CLN-2: header text -> column name (steps in the reference's order)."""
    h = strip_ws(F.coalesce(col(header), F.lit("")))
    h = F.replace(F.replace(F.replace(h, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")),
                  F.lit("  "), F.lit(" "))
    h = unaccented(h)
    for old, new in HEADER_REPLACEMENTS:
        h = F.replace(h, F.lit(old), F.lit(new))
    h = F.when(h.rlike("^[0-9]"), F.concat(F.lit("col_"), h)).otherwise(h)
    h = F.regexp_replace(F.regexp_replace(h, "_{2,}", "_"), "_+$", "")
    placeholder = F.concat(F.lit("coluna_"), col(index).cast("string"))
    return F.when((h == "") | F.lower(h).contains("unnamed"), placeholder).otherwise(h)


def fraction_text(v: Column) -> Column:
    """CLN-9: 'a/b' (digits only, one slash, b != 0) -> quotient rounded to 6
    (half-even), printed like Python: trailing zeros dropped, '.0' kept."""
    is_frac = v.rlike(r"^[0-9]+/[0-9]+$")
    parts = F.split(v, "/")
    a = F.get(parts, 0).try_cast("double")
    b = F.get(parts, 1).try_cast("double")
    q = F.bround(F.try_divide(a, F.when(b != 0, b)), 6).try_cast("decimal(38,6)").cast("string")
    q = F.regexp_replace(q, "0+$", "")
    q = F.when(q.endswith("."), F.concat(q, F.lit("0"))).otherwise(q)
    return F.when(is_frac & q.isNotNull(), q).otherwise(v)


def clean_cell(value) -> Column:
    """CLN-6..9: NULL -> '', trim, whole-cell blanks -> '', fraction -> decimal."""
    v = strip_ws(F.coalesce(col(value), F.lit("")))
    v = F.when(v.isin(*C.BLANK_CELLS), F.lit("")).otherwise(v)
    return fraction_text(v)
