"""Operator-level micro-fixtures and invariants."""

import datetime as dt
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from notaflow.functions.exprs import money
from notaflow.operators import loading, marts, rank, staging, views
from notaflow.sources import adapter
from notaflow.sources.adapter import INVOICE_COLS, MONEY_COLS

AS_OF = "2024-06-30"


def invoices(spark, rows):
    """rows: dicts with a subset of the 27 columns."""
    base = {c: None for c in INVOICE_COLS}
    recs = [{**base, **r} for r in rows]
    schema = ", ".join(f"{c} {'double' if c in MONEY_COLS else 'date' if c.startswith('data_') else 'string'}"
                       for c in INVOICE_COLS)
    df = spark.createDataFrame([tuple(r[c] for c in INVOICE_COLS) for r in recs], schema)
    return df.select(*[money(c).alias(c) if c in MONEY_COLS else F.col(c) for c in INVOICE_COLS])


def test_customer_single_date_has_null_ltv(spark):
    inv = invoices(spark, [dict(tomador_cnpj="1", data_emissao=dt.date(2024, 6, 1), valor_liquido=50000.0)])
    r = views.customer_performance(inv, AS_OF).first()
    assert r["relacionamento_dias"] == 0 and r["ltv_estimado"] is None
    assert r["categoria_valor"] == "PREMIUM" and r["score_reativacao"] == 100


def test_thresholds_inclusive_vs_strict(spark):
    inv = invoices(spark, [dict(tomador_cnpj=str(i), data_emissao=dt.date(2024, 6, 1), valor_liquido=v)
                           for i, v in enumerate([5000.0, 20000.0, 50000.0])])
    cls = {r["tomador_cnpj"]: r["categoria_valor"] for r in views.customer_performance(inv, AS_OF).collect()}
    assert cls == {"0": "MEDIO_VALOR", "1": "ALTO_VALOR", "2": "PREMIUM"}
    seg = spark.createDataFrame([(v,) for v in [5000.0, 20000.0, 50000.0]], "faturamento_total double")
    from notaflow.functions.exprs import band
    from notaflow.config import RULES
    got = [r[0] for r in seg.select(band(F.col("faturamento_total"), RULES.segment, RULES.segment_default, ">")).collect()]
    assert got == ["LOW_TICKET", "STANDARD", "PREMIUM"]


def test_null_tax_drops_row_from_withheld_sum(spark):
    inv = invoices(spark, [
        dict(tomador_cnpj="1", data_emissao=dt.date(2024, 6, 1), valor_servicos=100.0, valor_pis=1.0,
             valor_cofins=1.0, valor_inss=1.0, valor_ir=1.0, valor_csll=1.0),
        dict(tomador_cnpj="1", data_emissao=dt.date(2024, 6, 2), valor_servicos=100.0, valor_pis=2.0,
             valor_cofins=2.0, valor_inss=None, valor_ir=2.0, valor_csll=2.0)])
    r = views.tax_recovery(inv, AS_OF).first()
    assert r["impostos_federais_retidos"] == 5.0 and r["total_pis"] == 3.0


def test_first_month_growth_is_declinio(spark):
    inv = invoices(spark, [dict(tomador_cnpj="1", data_emissao=dt.date(2024, 1, 5), valor_liquido=0.0),
                           dict(tomador_cnpj="1", data_emissao=dt.date(2024, 2, 5), valor_liquido=10.0)])
    rows = views.executive_kpis(inv).orderBy("mes").collect()
    assert rows[0]["growth_rate_receita"] is None and rows[0]["performance_classificacao"] == "DECLINIO"
    assert rows[1]["growth_rate_receita"] is None  # zero revenue before


def test_place_with_only_null_cnpj(spark):
    inv = invoices(spark, [dict(tomador_uf="SP", tomador_municipio=None, data_emissao=dt.date(2024, 6, 1),
                                valor_liquido=10.0)])
    r = views.geo_expansion(inv, AS_OF).first()
    assert r["classificacao_mercado"] == "NAO_ATENDIDO" and r["densidade_clientes_municipio"] is None


def test_global_row_number_matches_plain_window(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("v"), F.col("id").alias("k"))
    order = [F.col("v").desc(), F.col("k")]
    ours = rank.global_row_number(df, order, "rn", num_partitions=7)
    plain = df.select("v", "k", F.row_number().over(Window.orderBy(*order)).alias("rn2"))
    j = ours.join(plain, ["v", "k"])
    assert j.count() == 5000 and j.filter(F.col("rn") != F.col("rn2")).count() == 0


def raw_rows(spark, docs):
    """docs: (arquivo_tipo, doc dict, cnpj column, ts)"""
    rows = [("f.xlsx", t, "S", json.dumps(d, ensure_ascii=False), c, None, None, None, i, None,
             dt.datetime(2024, 1, 1) + dt.timedelta(days=ts), "b", "drive", "processed", None)
            for i, (t, d, c, ts) in enumerate(docs)]
    schema = ("arquivo_nome string, arquivo_tipo string, aba_nome string, dados_json string, cnpj string, "
              "data_emissao date, valor double, cliente string, linha_original bigint, hash_linha string, "
              "_ingestion_timestamp timestamp, _ingestion_batch_id string, _source_bucket string, "
              "_processing_status string, _processing_error string")
    return spark.createDataFrame(rows, schema)


def test_staging_blank_cnpj_wins_and_odd_keys(spark):
    raw = raw_rows(spark, [
        ("clientes_atuais", {"cnpj": "", "CNPJ": "11.222.333/0001-81", "Num.": "7", "data": "2024-1-5",
                             "Liquido": "10.5", "cliente": {"x": 1}}, None, 0),
        ("clientes_atuais", {"CNPJ": "11.222.333/0001-81", "Nota Fiscal nº": "8", "emissao": "45000",
                             "VALOR NOTA FISCAL": "3"}, None, 0),
    ])
    got = {r["numero_nota"]: r for r in staging.billing(raw).collect()}
    assert got["7"]["cnpj"] == "" and got["7"]["cliente"] is None
    assert got["7"]["data_emissao"] == dt.date(2024, 1, 5) and got["7"]["valor_liquido"] == 10.5
    assert got["8"]["cnpj"] == "11222333000181" and got["8"]["data_emissao"] == dt.date(2023, 3, 15)


def test_dimension_latest_null_wins_and_blank_cnpj_fact(spark):
    raw = raw_rows(spark, [
        ("empresas_antigas", {"cnpj": "1", "razao_social": "Old", "endereco": "Rua A, 10, Campo/SP"}, None, 0),
        ("empresas_antigas", {"cnpj": "1", "razao_social": None, "endereco": "Rua A, 10, Campo/SP"}, None, 5),
        ("clientes_atuais", {"cnpj": "1", "data": "2024-06-01", "valor_liquido": "5000"}, None, 0),
        ("clientes_atuais", {"cnpj": "", "data": "2024-06-01", "valor_liquido": "1"}, None, 0),
    ])
    bill, comp = staging.billing(raw), staging.companies(raw)
    dim = marts.dim_customers(bill, comp, AS_OF)
    rows = dim.collect()
    assert len(rows) == 1 and rows[0]["razao_social"] == "Nome não identificado"
    assert rows[0]["cidade"] == "Campo" and rows[0]["uf"] == "SP" and rows[0]["cliente_key"] == 1
    fact = {r["cnpj"]: r["cliente_key"] for r in marts.fact_billing(bill, dim).collect()}
    assert fact == {"1": 1, "": None}


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    inv = invoices(spark, [dict(numero_nfse=str(i % 3), codigo_verificacao="c", data_emissao=dt.date(2024, 1, 1),
                                valor_liquido=float(i)) for i in range(6)])
    inv = inv.withColumn("hash_nfse", F.sha2(F.concat("numero_nfse", "codigo_verificacao"), 256))
    path = str(tmp_path / "nfse")
    first = loading.insert_if_absent(inv, path).first()
    second = loading.insert_if_absent(inv, path).first()
    assert (first["linhas_lote"], first["inseridas"]) == (6, 3)
    assert second["inseridas"] == 0 and spark.read.parquet(path).count() == 3
    # deterministic first row per hash: the smallest row
    kept = {r["numero_nfse"]: float(r["valor_liquido"]) for r in spark.read.parquet(path).collect()}
    assert kept == {"0": 0.0, "1": 1.0, "2": 2.0}


def test_adapter_invoice_invariants(spark):
    from tests.conftest import SF
    inv = adapter.invoices(spark, SF)
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert inv.count() == li.count()
    keys = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct().count()
    assert inv.select("numero_nfse").distinct().count() == keys


def test_no_single_partition_on_customer_path(spark):
    from tests.conftest import SF
    inv = adapter.invoices(spark, SF)
    plan = views.customer_performance(inv, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_daily_report_and_views(spark, tmp_path):
    from tests.conftest import SF
    from notaflow.operators import scoring
    from notaflow.plans import registry as R
    kpis = R.q_executive_kpis(spark, SF)
    scored = R.q_client_score(spark, SF)
    scoring.daily_report(kpis, scored, str(tmp_path / "rel"), k=5)
    assert spark.read.parquet(str(tmp_path / "rel" / "kpis")).count() == kpis.count()
    assert spark.read.parquet(str(tmp_path / "rel" / "oportunidades")).count() <= 5
    names = R.register_views(spark, SF)
    assert "customer_performance" in names
    assert spark.sql("SELECT COUNT(*) FROM tax_recovery").first()[0] > 0


def test_load_typed_quarantines_bad_values(spark, tmp_path):
    from notaflow.operators import cleaning
    clean = spark.createDataFrame(
        [("f", "S", 1, 0, "V", "1,5"), ("f", "S", 1, 1, "D", "2024-1-5"),
         ("f", "S", 2, 0, "V", "1.234,56"), ("f", "S", 2, 1, "D", "5/1/2024"),
         ("f", "S", 3, 0, "V", ""), ("f", "S", 3, 1, "D", "sem data")],
        "arquivo_nome string, aba_nome string, linha long, coluna int, coluna_nome string, valor string")
    typed = cleaning.typed_rows(clean, [("valor", "FLOAT", "V"), ("data", "DATE", "D"), ("obs", "STRING", None)],
                                with_errors=True)
    rep = cleaning.load_typed(typed, str(tmp_path / "ok"), str(tmp_path / "bad"))
    assert rep == {"linhas": 3, "inseridas": 1, "erros": 2, "taxa_sucesso_pct": 33.3}
    good = spark.read.parquet(str(tmp_path / "ok")).first()
    assert good["valor"] == 1.5 and good["data"] == dt.date(2024, 1, 5) and good["obs"] is None


def test_header_dedup_repeats_until_unique(spark):
    from notaflow.operators import cleaning
    hdr = spark.createDataFrame([("f", "S", i, n) for i, n in enumerate(["A", "A", "A_1", "B"])],
                                "arquivo_nome string, aba_nome string, coluna int, nome string")
    got = [r["nome"] for r in cleaning.dedupe_headers(hdr).orderBy("coluna").collect()]
    assert got == ["A", "A_1", "A_1_1", "B"]


def test_stamp_and_run_report(spark):
    from notaflow.operators import cleaning
    df = spark.createDataFrame([("FATURAMENTO 2009.xlsx",), ("x.csv",)], "arquivo_nome string")
    got = {r["arquivo_nome"]: r for r in cleaning.stamp(df, "2024-06-30", "Cliente X").collect()}
    assert got["FATURAMENTO 2009.xlsx"]["tipo_arquivo"] == "faturamento_historico"
    assert got["x.csv"]["tipo_arquivo"] == "desconhecido"
    assert got["x.csv"]["data_processamento"] == dt.date(2024, 6, 30)
    ledger = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("c", "erro")], "arquivo_nome string, status string")
    assert [(r[0], r[1]) for r in loading.run_report(ledger).collect()] == [("erro", 1), ("ok", 2)]
