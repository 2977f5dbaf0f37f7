"""Typed loads that run again, their quarantine and their report (SNK-1, CLN-10, RPT-1)."""

import datetime as dt

from pyspark.sql import functions as F

from notaflow.operators import cleaning
from notaflow.sinks import lots

CELLS = "arquivo_nome string, aba_nome string, linha long, coluna int, coluna_nome string, valor string"
TARGET = [("valor", "FLOAT", "V"), ("data", "DATE", "D"), ("instante", "DATETIME", "D"), ("obs", "STRING", None)]


def typed(spark, rows):
    return cleaning.typed_rows(spark.createDataFrame(rows, CELLS), TARGET, with_errors=True)


def test_a_load_that_runs_again_replaces_its_rows(spark, tmp_path):
    good, bad = str(tmp_path / "ok"), str(tmp_path / "bad")
    first = [("f", "S", 1, 0, "V", "1,5"), ("f", "S", 1, 1, "D", "2024-1-5 10:30:00"),
             ("f", "S", 2, 0, "V", "1.234,56"), ("f", "S", 2, 1, "D", "sem data"),
             ("g", "S", 1, 0, "V", None), ("g", "S", 1, 1, "D", "nan")]
    for _ in range(2):
        stamped = cleaning.stamp(typed(spark, first), "2024-02-01", "acme")
        rep = cleaning.load_typed(stamped, good, bad, "carga-1")
        assert rep == {"linhas": 3, "inseridas": 2, "erros": 1, "taxa_sucesso_pct": 66.7}
    cleaning.load_typed(cleaning.stamp(typed(spark, [("f", "S", 9, 0, "V", "2")]), "2024-02-02", "acme"), good, bad, "carga-2")
    rows = lots.read_store(spark, good).orderBy("arquivo_nome", "linha").collect()
    assert [(r.arquivo_nome, r.linha, r.valor) for r in rows] == [("f", 1, 1.5), ("f", 9, 2.0), ("g", 1, None)]
    assert rows[0].data == dt.date(2024, 1, 5) and rows[0].instante == dt.datetime(2024, 1, 5, 10, 30)
    assert rows[0].cliente_nome == "acme" and rows[0].data_processamento == dt.date(2024, 2, 1)
    kept_back = lots.read_store(spark, bad)
    assert [(r.linha, r.valores_invalidos) for r in kept_back.collect()] == [(2, 3)]  # a number, a date, an instant
    report = {r.arquivo_nome: r for r in cleaning.typed_load_report(lots.read_store(spark, good), kept_back).collect()}
    assert tuple(report["f"])[1:] == (3, 2, 1, 3, 66.7) and tuple(report["g"])[1:] == (1, 1, 0, 0, 100.0)


def test_a_load_of_nothing(spark, tmp_path):
    good, bad = str(tmp_path / "ok"), str(tmp_path / "bad")
    rep = cleaning.load_typed(typed(spark, []), good, bad, "carga-1")
    assert rep == {"linhas": 0, "inseridas": 0, "erros": 0, "taxa_sucesso_pct": 0.0}
    schema = typed(spark, []).drop("__erros").schema
    assert lots.read_store(spark, good, schema).count() == 0
    assert lots.committed(spark, f"{good}/dados") == ["carga-1"]


def test_report_shares_round_away_from_zero(spark):
    good = spark.range(1).select(F.lit("f").alias("arquivo_nome"))
    bad = spark.range(7).select(F.lit("f").alias("arquivo_nome"), F.lit(1).alias("valores_invalidos"))
    assert cleaning.typed_load_report(good, bad).first().taxa_sucesso_pct == 12.5
