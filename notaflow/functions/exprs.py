"""Scalar column expressions shared by every operator (SCL-*, COE-*, STG-3)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of: str | _dt.date) -> Column:
    return F.lit(str(as_of)).cast("date")


def band(value: Column, bands: Sequence[tuple], default, op: str = "<=") -> Column:
    """First matching ``(bound, out)``: ``value <op> bound``; NULL falls to default."""
    expr = None
    for bound, out in bands:
        cond = {"<=": value <= bound, ">=": value >= bound, ">": value > bound,
                "==": value == bound}[op]
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return expr.otherwise(F.lit(default))


def lookup(value: Column, pairs: Sequence[tuple], default) -> Column:
    """Simple CASE: value = key -> out."""
    expr = None
    for key, out in pairs:
        expr = F.when(value == key, F.lit(out)) if expr is None else expr.when(value == key, F.lit(out))
    return expr.otherwise(F.lit(default))


def money(c) -> Column:
    """Canonical money type inside the engine: exact decimal(18,2)."""
    return col(c).cast(MONEY)


def to_double(c) -> Column:
    """Output boundary: exact decimal -> double (correctly rounded)."""
    return col(c).cast("double")


def mean_of(sum_col: Column, count_col: Column) -> Column:
    """Mean as double(sum)/count — identical across engines, NULL on empty."""
    return F.try_divide(sum_col.cast("double"), count_col)


def round_half_away(c: Column, digits: int) -> Column:
    """ROUND(x, d) with half away from zero, computed in plain IEEE steps."""
    scale = 10 ** digits
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def months_before(as_of: Column, n: int) -> Column:
    return F.add_months(as_of, -n)


def clean_digits(c) -> Column:
    """Strip every non-digit (REGEXP_REPLACE(x, '[^0-9]', ''))."""
    return F.regexp_replace(col(c), r"[^0-9]", "")


_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip_ws(c) -> Column:
    """Unicode-aware trim (Spark ``trim`` strips only the ASCII space)."""
    return F.regexp_replace(F.regexp_replace(col(c), "^" + _WS + "+", ""), _WS + "+$", "")


def blank_to_null(c) -> Column:
    """COE-1: NULL, '' or 'nan' -> NULL."""
    v = col(c)
    return F.when(v.isNull() | v.isin("", "nan"), F.lit(None).cast("string")).otherwise(v)


def safe_iso_date(c) -> Column:
    """SAFE.PARSE_DATE('%Y-%m-%d', x): lenient on one-digit month/day."""
    return F.try_to_date(col(c), "yyyy-M-d")


def serial_date(c) -> Column:
    """Spreadsheet serial (text holding an integer) -> date from 1899-12-30."""
    v = col(c)
    n = v.try_cast("bigint")
    is_int = v.rlike(r"^\s*[+-]?[0-9]+\s*$")
    ok = is_int & n.between(0, C.SERIAL_MAX)
    return F.when(ok, F.date_add(F.lit(C.SERIAL_EPOCH).cast("date"), n.cast("int")))


def lenient_date(c) -> Column:
    """COE-4: first format that parses; day-first for the slash form (Brazil)."""
    v = strip_ws(c)
    fmts = ["yyyy-M-d", "yyyy-M-d H:mm:ss", "yyyy-M-d'T'H:mm:ss", "d/M/yyyy", "d/M/yyyy H:mm:ss",
            "d-M-yyyy", "yyyyMMdd", "yyyy/M/d"]
    return F.coalesce(*[F.try_to_date(v, f) for f in fmts])


def lenient_timestamp(c) -> Column:
    """COE-5: first timestamp format that parses."""
    v = strip_ws(c)
    fmts = ["yyyy-M-d H:mm:ss", "yyyy-M-d'T'H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d",
            "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy"]
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in fmts])


_NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_float(c) -> Column:
    """COE-3: comma -> dot, then a guarded numeric parse; bad -> NULL."""
    v = F.replace(strip_ws(c), F.lit(","), F.lit("."))
    return F.when(v.rlike(_NUMERIC), v.try_cast("double"))


def week_sunday(d) -> Column:
    """EXTRACT(WEEK) with Sunday-first weeks, 0..53 (C ``%U``)."""
    d = col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def tail_city_state(address) -> tuple[Column, Column]:
    """City and state from the text after the last comma, split on '/'."""
    tail = F.regexp_extract(col(address), r",\s*([^,]+)$", 1)
    tail = F.when(tail != "", tail)
    parts = F.split(tail, "/")
    return strip_ws(F.get(parts, 0)), strip_ws(F.get(parts, 1))


def invoice_hash(numero, codigo, data_text) -> Column:
    """SHA-256 of number+code+date text; a missing part prints as 'None'."""
    parts = [F.coalesce(col(x).cast("string"), F.lit("None")) for x in (numero, codigo, data_text)]
    return F.sha2(F.concat(*parts), 256)


def document_scalars(document) -> Column:
    """A JSON document as ``map<string,string>`` of its scalars: objects and arrays are
    left out; text such as ``[ABC] Ltda``, which is no JSON, is a scalar."""
    m = F.from_json(col(document), "map<string,string>")
    return F.map_filter(m, lambda k, v: ~(F.coalesce(F.substring(v, 1, 1).isin("{", "["), F.lit(False))
                                          & F.try_parse_json(v).isNotNull()))


def document_value(m: Column, key: str) -> Column:
    """JSON_VALUE semantics over ``document_scalars``: NULL when the key is absent or
    held no scalar."""
    return F.try_element_at(m, F.lit(key))


def document_variant(document) -> Column:
    """A JSON document as a Variant. One that holds a key twice is none; its scalars are
    taken, of a key's values the first. What is no JSON gives NULL."""
    m = document_scalars(document)
    first = F.map_from_entries(F.transform(F.array_distinct(F.map_keys(m)), lambda k: F.struct(k, F.element_at(m, k))))
    return F.coalesce(F.try_parse_json(col(document)), F.when(m.isNotNull(), F.to_variant_object(first)))


def variant_value(v: Column, key: str) -> Column:
    """JSON_VALUE semantics over a Variant: scalars as text (numbers without trailing
    zeros), NULL for objects and arrays. Nesting is known by type: text that looks like an
    object stays text."""
    path = f"$['{key}']"
    text = F.try_variant_get(v, path, "string")
    opens = F.coalesce(F.substring(text, 1, 1).isin("{", "["), F.lit(False))
    nested = (F.try_variant_get(v, path, "map<string,variant>").isNotNull()
              | F.try_variant_get(v, path, "array<variant>").isNotNull())
    return F.when(~(opens & nested), text)


def check_digits_ok(digits: Column, length: int, w1: Sequence[int], w2: Sequence[int]) -> Column:
    """Mod-11 check digits as pure column arithmetic (CNPJ / CPF)."""
    d = digits

    def dig(i: int) -> Column:
        return F.substring(d, i + 1, 1).cast("int")

    def dv(weights: Sequence[int]) -> Column:
        s = sum((dig(i) * w for i, w in enumerate(weights)), F.lit(0))
        r = s % 11
        return F.when(r < 2, F.lit(0)).otherwise(11 - r)

    n1, n2 = len(w1), len(w2)
    well_formed = d.rlike("^[0-9]{%d}$" % length) & ~d.rlike(r"^(\d)\1*$")
    return F.coalesce(well_formed & (dv(w1) == dig(n1)) & (dv(w2) == dig(n2)), F.lit(False))


def cnpj_ok(c) -> Column:
    return check_digits_ok(col(c), 14, C.CNPJ_W1, C.CNPJ_W2)


def cpf_ok(c) -> Column:
    return check_digits_ok(col(c), 11, C.CPF_W1, C.CPF_W2)
