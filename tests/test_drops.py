"""CSV and JSON-lines files as cells."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from notaflow.sources import drops
from notaflow.sinks import lots
from notaflow.streaming import landing


def cells(df):
    return sorted(((r.arquivo_nome, r.linha, r.coluna, r.valor) for r in df.where("erro IS NULL").collect()), key=str)


def bad(df):
    return sorted(((r.arquivo_nome, r.linha, r.valor, r.erro) for r in df.where("erro IS NOT NULL").collect()), key=str)


def test_csv_separators_quotes_and_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Nome;CNPJ;"x;y"\r\n;"1 ""a"" ; b";z"w\r\n\r\n"aberta;1;2\r\nso um\r\n1;2;3;4\r\n"a"b;c;d\r\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('p|q\n1|\n\n|2\n')
    (tmp_path / "c.csv").write_text('p,"q\n1,2\n')
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e +1%20.csv").write_text("so\nx\n")
    got = drops.csv_cells(drops.text_lines(spark, str(tmp_path), "*.csv"))
    assert cells(got) == sorted([
        ("a.csv", 0, 0, "Nome"), ("a.csv", 0, 1, "CNPJ"), ("a.csv", 0, 2, "x;y"), ("a.csv", 1, 1, '1 "a" ; b'), ("a.csv", 1, 2, 'z"w'),
        ("a.csv", 3, 0, "so um"), ("b.csv", 0, 0, "p"), ("b.csv", 0, 1, "q"), ("b.csv", 1, 0, "1"), ("b.csv", 2, 1, "2"),
        ("e +1%20.csv", 0, 0, "so"), ("e +1%20.csv", 1, 0, "x")], key=str)
    assert bad(got) == sorted([("a.csv", 2, '"aberta;1;2', drops.BAD_QUOTES), ("a.csv", 4, "1;2;3;4", drops.TOO_MANY),
                               ("a.csv", 5, '"a"b;c;d', drops.BAD_QUOTES), ("c.csv", None, 'p,"q', drops.BAD_HEADER)], key=str)


@pytest.mark.parametrize("block", [64, 1000])
def test_csv_split_over_tasks_equals_the_csv_module(spark, tmp_path, block):
    """A file read in many blocks keeps its line numbers."""
    rows = [["a", "b,b", "c"]] + [[str(i), f'v"{i}",x' if i % 3 else "", "é" * (i % 40) or "."] for i in range(400)]
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerows(rows)
    (tmp_path / "t.csv").write_text(buf.getvalue(), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = cells(drops.csv_cells(drops.text_lines(spark, str(tmp_path), "*.csv")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted([("t.csv", i, j, v) for i, r in enumerate(rows) for j, v in enumerate(r) if v], key=str)


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"b": "x", "a": 1.50}\n\n{"c": {"k": [1, 2]}, "a": null}\n{}\n[1]\n{"a": \nnada\n{"b": "1", "b": "2"}\n')
    (tmp_path / "b.jsonl").write_text("nada\n")
    got = drops.jsonl_cells(drops.text_lines(spark, str(tmp_path), "*.jsonl"))
    assert cells(got) == sorted([
        ("a.jsonl", 0, 0, "b"), ("a.jsonl", 0, 1, "a"), ("a.jsonl", 0, 2, "c"), ("a.jsonl", 1, 0, "x"), ("a.jsonl", 1, 1, "1.5"),
        ("a.jsonl", 2, 2, '{"k":[1,2]}'), ("a.jsonl", 7, 0, "1")], key=str)
    assert [(r[0], r[1]) for r in bad(got)] == [("a.jsonl", 4), ("a.jsonl", 5), ("a.jsonl", 6), ("b.jsonl", 1)]


def test_differing_headers_give_one_raw_table(spark, tmp_path):
    """Two CSV files and one of JSON lines, streamed, once more as a replay."""
    src, raw = tmp_path / "in", str(tmp_path / "raw")
    src.mkdir()
    (src / "faturamento 1.csv").write_text("CNPJ;Valor\n11.222.333/0001-81;1,5\n")
    (src / "faturamento 2.csv").write_text("Cliente,CNPJ\nAna,11222333000181\n\"x\n")
    (src / "faturamento 3.jsonl").write_text('{"Valor": 2, "Cliente": "Bia"}\n')
    for n in range(2):
        for kind in ("csv", "jsonl"):
            lines = drops.text_lines(spark.readStream, str(src), f"*.{kind}")
            landing.ingest_text_stream(lines, kind, raw, str(tmp_path / f"ck-{kind}-{n}"), str(tmp_path / "ruins"))
    got = landing.read_stored(spark, raw)
    assert sorted(r.dados_json for r in got.collect()) == [
        '{"CNPJ":"11.222.333/0001-81","Valor":"1,5"}', '{"Cliente":"Ana","CNPJ":"11222333000181"}'.replace(
            '"Cliente":"Ana","CNPJ":"11222333000181"', '"CNPJ":"11222333000181","Cliente":"Ana"'), '{"Cliente":"Bia","Valor":"2"}']
    ruins = lots.read_lots(spark, str(tmp_path / "ruins"), lots.committed(spark, str(tmp_path / "ruins")))
    assert {(r.arquivo_nome, r.linha, r.texto) for r in ruins.collect()} == {("faturamento 2.csv", 2, '"x')}
    assert got.where(F.col("cnpj") == "11222333000181").count() == 2
