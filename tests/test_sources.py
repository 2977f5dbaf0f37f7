"""Sources: invoice XML, workbooks, streaming."""

import datetime as dt

from pyspark.sql import functions as F

from notaflow.sources import files, xml

NS_DOC = ('<ns2:ConsultarNfseResposta xmlns:ns2="urn:x"><ns2:ListaNfse>'
          '<ns2:CompNfse><ns2:Nfse><ns2:InfNfse><ns2:Numero>007</ns2:Numero><ns2:DataEmissao>2024-01-05T10:00:00'
          '</ns2:DataEmissao><ns2:Servico><ns2:Valores><ns2:ValorIss>abc</ns2:ValorIss><ns2:ValorPis>1.5</ns2:ValorPis>'
          '</ns2:Valores></ns2:Servico></ns2:InfNfse></ns2:Nfse></ns2:CompNfse>'
          '<ns2:CompNfse><ns2:Outro>x</ns2:Outro></ns2:CompNfse>'
          '</ns2:ListaNfse></ns2:ConsultarNfseResposta>')
PLAIN_DOC = ('<ConsultarNfseResposta><ListaNfse><CompNfse><Nfse><InfNfse><Numero>9</Numero>'
             '<TomadorServico><IdentificacaoTomador><CpfCnpj><Cnpj>11222333000181</Cnpj></CpfCnpj>'
             '</IdentificacaoTomador><Endereco><Endereco>Rua A</Endereco><Numero>10</Numero></Endereco>'
             '</TomadorServico></InfNfse></Nfse></CompNfse></ListaNfse></ConsultarNfseResposta>')
BROKEN_DOC = '<ConsultarNfseResposta><ListaNfse><CompNfse><Nfse><InfNfse><Numero>1</Numero>'


def test_xml_response_parsing(spark):
    docs = spark.createDataFrame([(NS_DOC,), (PLAIN_DOC,), (BROKEN_DOC,)], "xml string")
    rows = {r["numero_nfse"]: r for r in xml.parse_response_column(docs, "2024-06-30").collect()}
    assert set(rows) == {"007", "9"}
    a = rows["007"]
    assert float(a["valor_iss"]) == 0.0 and float(a["valor_pis"]) == 1.5 and float(a["valor_liquido"]) == 0.0
    assert a["data_emissao"] == dt.date(2024, 1, 5)
    b = rows["9"]
    assert b["tomador_cnpj"] == "11222333000181" and b["tomador_endereco"] == "Rua A"


NOTE = "<CompNfse><Nfse><InfNfse><Numero>{}</Numero><Servico><Discriminacao>{}</Discriminacao></Servico></InfNfse></Nfse></CompNfse>"


def test_xml_structure_is_read_not_cut(spark):
    """Notes in comments are none, tags in CDATA are text, and a broken document keeps its whole notes on request."""
    rows = [(1, "<R><!-- " + NOTE.format(1, "x") + " -->" + NOTE.format(2, "a &amp; b") + "</R>"),
            (2, "<R>" + NOTE.format(3, "<![CDATA[a </CompNfse> <p:b>]]> c") + "</R>"),
            (3, "<R>" + NOTE.format(4, "x") + NOTE.format(5, "y") + NOTE.format(6, "z")[:-30]),
            (4, "<R>" + NOTE.format(7, "x") + "<CompNfse><Outro/></CompNfse></S>"), (5, None),
            (6, '<!DOCTYPE R [<!ENTITY a "b">]><R>' + NOTE.format(8, "&a;") + "</R>"),
            (7, "<R><CompNfse><Nfse><Numero>9</Numero></Nfse></CompNfse><x:CompNfse><x:Nfse><x:InfNfse><x:Numero> 10 </x:Numero>"
                "<Numero>11</Numero><Outro><Numero>12</Numero></Outro></x:InfNfse></x:Nfse></x:CompNfse></R>")]
    docs = spark.createDataFrame(rows, "id int, xml string")
    strict = {r.numero_nfse: r.discriminacao for r in xml.parse_response_column(docs, "2024-01-01").collect()}
    assert strict == {"2": "a & b", "3": "a </CompNfse> <p:b> c", "10": None}
    kept = {r.numero_nfse for r in xml.parse_response_column(docs, "2024-01-01", salvage=True).collect()}
    assert kept == {"2", "3", "4", "5", "7", "10"}
    bad = {r.id: r._corrupt_record for r in xml.malformed(docs).collect()}
    assert set(bad) == {3, 4, 5, 6} and all(bad.values())


def test_documents_are_read_once(spark):
    docs = spark.createDataFrame([(1, "<R/>")], "id int, xml string")
    plan = xml.parse_response_column(docs, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_workbook_round_trip_and_listing(spark, tmp_path):
    content = files.build_workbook({"Aba1": [(0, 0, "Nota Fiscal nº"), (0, 1, " Cliente\n"), (1, 0, "1"),
                                             (1, 1, "Ana & Bia"), (3, 1, "x")],
                                    "Aba2": [(0, 0, "CNPJ")]})
    (tmp_path / "FATURAMENTO 2008.xlsx").write_bytes(content)
    (tmp_path / "ruim.xlsx").write_bytes(b"not a zip")
    listed = files.list_files(spark, str(tmp_path), "*.xlsx").collect()
    assert sorted(r["arquivo_nome"] for r in listed) == ["FATURAMENTO 2008.xlsx", "ruim.xlsx"]
    cells = files.decode_workbooks(files.read_files(spark, str(tmp_path)))
    good = cells.filter(F.col("erro").isNull()).orderBy("aba_nome", "linha", "coluna").collect()
    assert [(r["aba_nome"], r["linha"], r["coluna"], r["valor"]) for r in good] == [
        ("Aba1", 0, 0, "Nota Fiscal nº"), ("Aba1", 0, 1, " Cliente\n"), ("Aba1", 1, 0, "1"),
        ("Aba1", 1, 1, "Ana & Bia"), ("Aba1", 3, 1, "x"), ("Aba2", 0, 0, "CNPJ")]
    bad = cells.filter(F.col("erro").isNotNull()).collect()
    assert [r["arquivo_nome"] for r in bad] == ["ruim.xlsx"]


def test_shared_strings_and_date_cells():
    import io
    import zipfile
    buf = io.BytesIO()
    m = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{m}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{m}"><si><t>Data</t></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{m}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{m}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>12.0</v></c></row>'
                   '<row r="2"><c r="A2" s="1"><v>45000</v></c><c r="B2"><v>1.5</v></c><c r="C2" t="b"><v>1</v></c></row></sheetData></worksheet>')
    rows = files.decode_workbook("f.xlsx", buf.getvalue())
    assert [(r[2], r[3], r[4]) for r in rows] == [(0, 0, "Data"), (0, 1, "12"), (1, 0, "2023-03-15 00:00:00"),
                                                   (1, 1, "1.5"), (1, 2, "True")]


def test_stream_dedup_equals_batch(spark):
    from tests.conftest import SF
    from notaflow.plans.registry import q_stream_dedup
    out = q_stream_dedup(spark, SF)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert out.count() == events.count()
    assert out.select("event_id").distinct().count() == events.count()


def test_landing_stream_archives_and_replays_idempotently(spark, tmp_path):
    from notaflow.streaming import landing
    land, arch = tmp_path / "novos", tmp_path / "armazenados"
    land.mkdir()
    arch.mkdir()
    for i in range(2):
        (land / f"Todos Clientes {i}.xlsx").write_bytes(files.build_workbook(
            {"Aba1": [(0, 0, "CNPJ"), (0, 1, "Cliente"), (1, 0, f"0{i}"), (1, 1, "Ana"), (2, 0, "9"), (2, 1, "Bia")]}))
    raw = str(tmp_path / "raw")
    landing.ingest_landing(spark, str(land), raw, str(tmp_path / "ck1"), archive=str(arch))
    first = landing.read_stored(spark, raw)
    assert first.count() == 4
    assert set(first.select("arquivo_tipo").distinct().toPandas()["arquivo_tipo"]) == {"clientes_atuais"}
    # replay over the archive with a fresh checkpoint adds nothing
    archived = [p for p in arch.rglob("*.xlsx")]
    replay_dir = archived[0].parent if archived else land
    landing.ingest_landing(spark, str(replay_dir), raw, str(tmp_path / "ck2"))
    assert landing.read_stored(spark, raw).count() == 4


def test_contract_loader_and_schema():
    from notaflow import schemas
    cols = schemas.load_contract('[{"name": "id", "type": "STRING", "mode": "REQUIRED"},'
                                 ' {"name": "valor", "type": "NUMERIC", "precision": 15, "scale": 2}]')
    st = schemas.struct(cols)
    assert [f.nullable for f in st.fields] == [False, True]
    assert st.fields[1].dataType.simpleString() == "decimal(15,2)"
    assert len(schemas.INVOICE) == 27 and len(schemas.RAW) == 15 and len(schemas.FILE_METADATA) == 16
    assert len(schemas.NF_TRIBUTOS) == 10 and len(schemas.RPS_LOG) == 17


def test_xml_file_reader_one_response_per_file(spark, tmp_path):
    (tmp_path / "a.xml").write_text(NS_DOC)
    (tmp_path / "b.xml").write_text(PLAIN_DOC)
    got = sorted(r["numero_nfse"] for r in xml.read_response_files(spark, str(tmp_path), "2024-06-30").collect())
    assert got == ["007", "9"]


def test_datetime_coercion(spark):
    from notaflow.operators.cleaning import coerce
    df = spark.createDataFrame([("2024-01-05 10:30:00",), ("5/1/2024 08:00",), ("x",)], "v string")
    got = [r[0] for r in df.select(coerce(F.col("v"), "DATETIME")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 5, 8, 0), None]
