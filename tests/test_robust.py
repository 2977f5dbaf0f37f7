"""Nothing is lost or wrong on odd input: stream order, numbers, XML shapes, headers, reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from notaflow.functions import exprs, text
from notaflow.operators import cleaning, loading, marts, quality, staging
from notaflow.sources import files, xml
from notaflow.streaming import jobs, landing


def test_dedup_does_not_depend_on_file_order(spark, tmp_path):
    rows = spark.range(400).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int")))
                                   .alias("ts"), F.lit("u").alias("u"), F.lit(1.5).alias("v"))
    folder = str(tmp_path / "in")
    rows.repartitionByRange(4, "ts").write.parquet(folder)
    for n in (None, 1):
        out = jobs.stream_dedup(spark, folder, rows.schema, "*.parquet", "id", "ts", max_files=n)
        assert out.count() == out.select("id").distinct().count() == 400
    kpis = jobs.stream_kpis(spark, folder, rows.schema, "*.parquet", "id", "ts", "u", "v", max_files=1).collect()
    assert sum(r.eventos for r in kpis) == 400 and len(kpis) == 134 and all(r.usuarios == 1 for r in kpis)
    with pytest.raises(ValueError):
        jobs.stream_kpis(spark, folder, rows.schema, "*.parquet", "id", "ts", "u", "v", window_hours=5)


def test_an_unreadable_store_raises(spark, tmp_path):
    path = tmp_path / "store"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    batch = spark.createDataFrame([("a", 1)], "k string, p int")
    with pytest.raises(Exception):
        loading.append_new(batch, str(path), "k", "p")


NOTE = ("<CompNfse><Nfse><InfNfse><Numero>7</Numero><CodigoVerificacao>c</CodigoVerificacao>"
        "<DataEmissao>{date}</DataEmissao><TomadorServico>{taker}</TomadorServico></InfNfse></Nfse></CompNfse>")


@pytest.mark.parametrize("wrap", ["<R><ListaNfse>%s</ListaNfse></R>", "<R>%s</R>",
                                  "<s:Envelope xmlns:s='u'><s:Body><R><ListaNfse>%s</ListaNfse></R></s:Body></s:Envelope>"])
@pytest.mark.parametrize("taker", ["<IdentificacaoTomador><Cnpj>12</Cnpj></IdentificacaoTomador>",
                                   "<IdentificacaoTomador><CpfCnpj><Cnpj>12</Cnpj></CpfCnpj></IdentificacaoTomador>",
                                   "<CpfCnpj><Cnpj>12</Cnpj></CpfCnpj>", "<Cnpj>12</Cnpj>"])
def test_notes_at_any_depth(spark, wrap, taker):
    doc = wrap % NOTE.format(date="2024-01-05T23:30:00-03:00", taker=taker)
    docs = spark.createDataFrame([(doc,)], "xml string")
    r = xml.parse_response_column(docs, "2024-02-01").collect()
    assert len(r) == 1 and r[0].tomador_cnpj == "12" and r[0].data_emissao == dt.date(2024, 1, 5)
    assert xml.malformed(docs).count() == 0


def test_malformed_documents_are_kept_apart(spark):
    docs = spark.createDataFrame([("<R><a></R>",), (None,), ("",), ("<R/>",)], "xml string")
    assert xml.malformed(docs).count() == 3 and xml.parse_response_column(docs, "2024-02-01").count() == 0


def test_headers_are_unique_for_any_chain(spark):
    names = ["A", "A", "A_1", "A_1_1", "A_1_1_1", "A_1_1_1_1", "B", "A"]
    df = spark.createDataFrame([("f", "s", i, n, n) for i, n in enumerate(names)],
                               "arquivo_nome string, aba_nome string, coluna int, cabecalho string, nome string")
    got = [r.nome for r in cleaning.dedupe_headers(df).orderBy("coluna").collect()]
    assert len(set(got)) == len(names) and got[0] == "A" and got[6] == "B"


def test_numbers_that_are_none(spark):
    df = spark.createDataFrame([("nan",), ("inf",), ("1e999",), ("12.5",), ("1.5d",)], "v string")
    assert [r[0] for r in df.select(staging.safe_double(F.col("v"))).collect()] == [None, None, None, 12.5, None]
    bills = spark.createDataFrame([("1", dt.date(2024, 1, 1), 1e30), ("1", dt.date(2024, 1, 2), 10.0), ("1", dt.date(2024, 1, 3), float("nan"))],
                                  "cnpj string, data_emissao date, valor_liquido double")
    r = marts.billing_by_customer(bills).first()
    assert (r.total_notas, r.faturamento_total, r.ticket_medio) == (3, 10.0, 10.0)
    long = "1/3" + "0" * 45
    cells = spark.createDataFrame([(long,), ("1/4",)], "v string")
    assert [r[0] for r in cells.select(text.clean_cell("v")).collect()][1] == "0.25"


def test_bracketed_text_is_a_scalar(spark):
    df = spark.createDataFrame([('{"a":"[ABC] Ltda","b":[1],"c":{"d":1},"e":"x"}',)], "j string")
    m = df.select(exprs.document_scalars("j").alias("m")).first().m
    assert m == {"a": "[ABC] Ltda", "e": "x"}


def test_whole_pending_set_unless_a_lot_is_asked_for(spark):
    dim = spark.range(300).select(F.col("id").cast("string").alias("cnpj"), F.lit("n").alias("razao_social"),
                                  F.col("id").cast("double").alias("faturamento_total"), F.lit(1).alias("total_notas"))
    done = spark.createDataFrame([("299", "ATIVA")], "cnpj string, situacao_cadastral string")
    assert quality.pending_validation(dim, done).count() == 299
    assert [r.cnpj for r in quality.pending_validation(dim, done, lot=150).limit(2).collect()] == ["298", "297"]


def test_quarantine_names_the_rules(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "a", "N"), (3, None, None)], "id int, a string, s string")
    got = {r.id: list(r.violacoes) for r in quality.quarantine(df, ["a"], {"s": ["N"]}).collect()}
    assert got == {1: ["obrigatorio:a", "dominio:s"], 3: ["obrigatorio:a"]}


def test_cells_without_references(spark):
    import io
    import zipfile
    whole = files.build_workbook({"S": [(0, 0, "h"), (0, 1, "g"), (1, 0, "a"), (1, 1, "b")]})
    src, buf = zipfile.ZipFile(io.BytesIO(whole)), io.BytesIO()
    import re
    with zipfile.ZipFile(buf, "w") as z:
        for n in src.namelist():
            body = src.read(n).decode()
            z.writestr(n, re.sub(r'(<c|<row) r="[^"]*"', r"\1", body))
    rows = files.decode_workbook("f", buf.getvalue())
    assert [r[2:5] for r in rows] == [(0, 0, "h"), (0, 1, "g"), (1, 0, "a"), (1, 1, "b")]
    bad = files.decode_workbook("f", b"x" * 9)
    assert bad[0][1] is None and bad[0][5]


def test_typed_load_splits_good_and_bad(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "v int, __erros int")
    r = cleaning.load_typed(df, str(tmp_path / "ok"), str(tmp_path / "bad"))
    assert r == {"linhas": 3, "inseridas": 2, "erros": 1, "taxa_sucesso_pct": 66.7}


def test_landing_replay_adds_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "Faturamento 2008.xlsx").write_bytes(files.build_workbook(
        {"S": [(0, 0, "CNPJ"), (0, 1, "Data Emissão"), (0, 2, "Valor Líquido (R$)"), (0, 3, "Cliente"),
               (1, 0, "11.222.333/0001-81"), (1, 1, "05/01/2008"), (1, 2, "12,50"), (1, 3, "[ABC] Ltda")]}))
    (folder / "ruim.xlsx").write_bytes(b"no zip")
    raw, ledger = str(tmp_path / "raw"), str(tmp_path / "ledger")
    for i in range(2):
        landing.ingest_landing(spark, str(folder), raw, str(tmp_path / f"ck{i}"), ledger_path=ledger)
    got = landing.read_stored(spark, raw)
    assert got.count() == 1 and set(landing.RAW_COLS) <= set(got.columns)
    r = staging.billing(got).first()
    assert (r.cnpj, r.data_emissao, r.valor_liquido, r.cliente) == ("11222333000181", dt.date(2008, 1, 5), 12.5, "[ABC] Ltda")
    led = {r.arquivo_nome: r for r in landing.read_stored(spark, ledger).collect()}
    assert led["ruim.xlsx"].status == "erro" and led["ruim.xlsx"].erro_mensagem
    assert led["Faturamento 2008.xlsx"].status == "processado" and led["Faturamento 2008.xlsx"].total_linhas == 1
    assert loading.run_report(landing.read_stored(spark, ledger)).count() == 2
