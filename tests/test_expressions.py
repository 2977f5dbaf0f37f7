"""Micro-fixtures for the scalar rules (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from notaflow.functions import exprs as X
from notaflow.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_check_digits(spark):
    df = spark.createDataFrame([("11222333000181",), ("12345678000100",), ("11111111111111",),
                                ("1122233300018",), (None,)], "v string")
    got = [r["r"] for r in df.select(X.cnpj_ok(F.col("v")).alias("r")).collect()]
    assert got == [True, False, False, False, False]
    cpf = spark.createDataFrame([("52998224725",), ("52998224724",), ("00000000000",)], "v string")
    assert [r["r"] for r in cpf.select(X.cpf_ok(F.col("v")).alias("r")).collect()] == [True, False, False]


def test_dates_iso_and_serial(spark):
    assert one(spark, X.safe_iso_date, "2024-1-5") == dt.date(2024, 1, 5)
    assert one(spark, X.safe_iso_date, "2024-13-05") is None
    assert one(spark, X.serial_date, "45000") == dt.date(2023, 3, 15)
    assert one(spark, X.serial_date, "45000.5") is None
    assert one(spark, X.serial_date, "99999999999") is None


def test_week_sunday_first(spark):
    df = spark.createDataFrame([(dt.date(2007, 1, 1),), (dt.date(2006, 1, 1),)], "d date")
    assert [r[0] for r in df.select(X.week_sunday("d")).collect()] == [0, 1]


def test_address_tail(spark):
    rows = [("Rua A, 10, Campo/SP",), ("Rua A 10 Campo SP",), ("Rua A, 10, Campo",), ("Rua A, 10, Campo/SP\n",)]
    df = spark.createDataFrame(rows, "a string")
    c, u = X.tail_city_state(F.col("a"))
    got = [(r[0], r[1]) for r in df.select(c, u).collect()]
    assert got == [("Campo", "SP"), (None, None), ("Campo", None), ("Campo", "SP")]


def test_cells_blank_and_fraction(spark):
    vals = ["nan", "None", ".", " x ", "x None", "1/2", "1/0", "10/2023", "1/2/3", "a/b", "6/3", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(T.clean_cell(F.col("v"))).collect()]
    assert got == ["", "", "", "x", "x None", "0.5", "1/0", "0.004943", "1/2/3", "a/b", "2.0", ""]


def test_float_coercion(spark):
    df = spark.createDataFrame([("1,5",), ("1.234,56",), ("1.5d",), (" 7 ",)], "v string")
    assert [r[0] for r in df.select(X.parse_float(F.col("v"))).collect()] == [1.5, None, None, 7.0]


def test_header_normalisation(spark):
    heads = ["Nota Fiscal nº", "2020", "A/B (x)", "", "Unnamed: 3", "Razão Social", "Honorários %", " Obs.\n"]
    df = spark.createDataFrame([(h, i) for i, h in enumerate(heads)], "h string, i int")
    got = [r[0] for r in df.select(T.normalize_header(F.col("h"), F.col("i"))).collect()]
    assert got == ["Nota_Fiscal_n_num", "col_2020", "A_B_x", "coluna_3", "coluna_4", "Razao_Social",
                   "Honorarios_pct", "Obs"]


def test_file_classifier(spark):
    names = ["FATURAMENTO 2008.xlsx", "Faturamento 2015.xlsx", "Todos Clientes.xlsx", "Empresas Antigas.xlsx",
             "outro.xlsx"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(T.classify_file(F.col("n"))).collect()]
    assert got == ["faturamento_historico", "desconhecido", "clientes_atuais", "empresas_antigas", "desconhecido"]


def test_hash_prints_missing_as_none(spark):
    import hashlib
    df = spark.createDataFrame([("1", None, "2024-01-05")], "n string, c string, d string")
    got = df.select(X.invoice_hash("n", "c", "d")).first()[0]
    assert got == hashlib.sha256(b"1None2024-01-05").hexdigest()


def test_round_half_away(spark):
    df = spark.createDataFrame([(1.005,), (-2.5,), (2.675,)], "v double")
    got = [r[0] for r in df.select(X.round_half_away(F.col("v"), 2)).collect()]
    assert got == [1.0, -2.5, 2.68]  # 1.005 is 1.00499999... in binary


def test_header_marks_of_any_script(spark):
    """Decomposition, not a table of accents: the rule of the standard library."""
    import unicodedata
    names = ["Ação", "Ñandú Ǎ", "ệ ở ż", "Ångström", "й й", "été", "ﬁ ß ø", "ガ", "Número Nº", ""]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "h string, i int")
    got = [r[0] for r in df.select(T.unaccented(F.col("h"))).collect()]
    assert got == ["".join(c for c in unicodedata.normalize("NFD", n) if unicodedata.category(c) != "Mn") for n in names]
    named = [r[0] for r in df.select(T.normalize_header(F.col("h"), F.col("i"))).collect()]
    assert named[:2] == ["Acao", "Nandu_A"] and named[2] == "e_o_z" and named[8] == "Numero_N_num" and named[9] == "coluna_9"
