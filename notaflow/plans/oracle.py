"""DuckDB SQL oracles, one per registered query.

``INV`` rebuilds the adapter's invoice table in SQL with the same integer-cents
arithmetic; money columns are exact DECIMAL(18,2). Sums are cast to DOUBLE at
the output, means are DOUBLE(sum)/count, and ROUND(x, 2) is spelt as plain
IEEE steps, so both engines produce identical bits.
"""
# FIXED VALUES — labels, thresholds and document keys in the SQL below must equal the
# reference's for the comparison to mean anything; they are stated where they apply.
from __future__ import annotations

AS_OF = "DATE '2001-11-15'"

BASE = """
base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_shipdate, o.o_orderdate, o.o_orderstatus, o.o_custkey,
         c.c_custkey, c.c_name, n.n_name,
         4 * (1 + c.c_custkey % 40) * (CASE WHEN c.c_custkey % 3 = 0 THEN 4 ELSE 1 END) AS q
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
cents AS (
  SELECT *,
    CAST(floor(l_extendedprice / q * 100 + 0.5) AS BIGINT) AS vs_c,
    CAST(floor(l_extendedprice * (1 - l_discount) / q * 100 + 0.5) AS BIGINT) AS vl_c
  FROM base
),
cents2 AS (
  SELECT *,
    (vs_c * 65 + 5000) // 10000 AS pis_c,
    (vs_c * 3 + 50) // 100 AS cofins_c,
    (vs_c * 15 + 500) // 1000 AS ir_c,
    (vs_c + 50) // 100 AS csll_c,
    CASE WHEN l_linenumber <> 7 THEN CAST(0 AS BIGINT) END AS inss_c,
    CAST(floor(CAST(vs_c AS DOUBLE) * l_tax + 0.5) AS BIGINT) AS iss_c,
    CAST(0 AS BIGINT) AS ded_c,
    CASE WHEN c_custkey % 97 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS cnpj_,
    CASE WHEN c_custkey % 53 <> 0
         THEN n_name || '-' || CAST(CAST(floor(sqrt(c_custkey % 100)) AS BIGINT) AS VARCHAR) END AS city_,
    '1.' || CAST(l_linenumber % (1 + c_custkey % 5) AS VARCHAR) AS item_
  FROM cents
)"""


def _m(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


INV = BASE + f""",
inv AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS numero_nfse,
    lpad(CAST((l_orderkey * 31 + l_linenumber * 7) % 1000000000 AS VARCHAR), 9, '0') AS codigo_verificacao,
    CAST(l_shipdate AS DATE) AS data_emissao,
    CAST(o_orderdate AS DATE) AS data_competencia,
    cnpj_ AS tomador_cnpj,
    c_name AS tomador_razao_social,
    city_ AS tomador_municipio,
    n_name AS tomador_uf,
    {_m('vs_c')} AS valor_servicos, {_m('ded_c')} AS valor_deducoes, {_m('pis_c')} AS valor_pis,
    {_m('cofins_c')} AS valor_cofins, {_m('inss_c')} AS valor_inss, {_m('ir_c')} AS valor_ir,
    {_m('csll_c')} AS valor_csll, {_m('iss_c')} AS valor_iss, {_m('vl_c')} AS valor_liquido,
    item_ AS item_lista_servico,
    l_orderkey, l_linenumber, c_custkey
  FROM cents2
)"""

RHA = "(sign({x}) * floor(abs({x}) * 100 + 0.5) / 100)"


def rha(x: str) -> str:
    return RHA.format(x=x)


CUSTOMER_PERFORMANCE = "WITH " + INV + f""",
m AS (
  SELECT tomador_cnpj, tomador_razao_social, tomador_uf, tomador_municipio,
    COUNT(*) AS total_nfses,
    CAST(SUM(valor_liquido) AS DOUBLE) AS faturamento_total,
    CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(valor_liquido) AS ticket_medio,
    MAX(data_emissao) AS ultima_nfse,
    MIN(data_emissao) AS primeira_nfse,
    date_diff('day', MAX(data_emissao), {AS_OF}) AS dias_sem_servico,
    date_diff('day', MIN(data_emissao), MAX(data_emissao)) AS relacionamento_dias,
    COUNT(DISTINCT month(data_emissao)) AS meses_ativos,
    COUNT(DISTINCT year(data_emissao)) AS anos_ativos
  FROM inv WHERE tomador_cnpj IS NOT NULL
  GROUP BY 1, 2, 3, 4
),
c AS (
  SELECT *,
    CASE WHEN dias_sem_servico <= 30 THEN 100 WHEN dias_sem_servico <= 90 THEN 80
         WHEN dias_sem_servico <= 180 THEN 60 WHEN dias_sem_servico <= 365 THEN 40 ELSE 20 END AS score_reativacao,
    CASE WHEN faturamento_total >= 50000 THEN 'PREMIUM' WHEN faturamento_total >= 20000 THEN 'ALTO_VALOR'
         WHEN faturamento_total >= 5000 THEN 'MEDIO_VALOR' ELSE 'BAIXO_VALOR' END AS categoria_valor,
    CASE WHEN dias_sem_servico <= 90 THEN 'ATIVO' WHEN dias_sem_servico <= 365 THEN 'INATIVO_RECENTE'
         ELSE 'INATIVO_LONGO' END AS status_cliente,
    CASE WHEN meses_ativos >= 12 AND ticket_medio >= 5000 THEN 'ALTO'
         WHEN meses_ativos >= 6 AND ticket_medio >= 2000 THEN 'MEDIO' ELSE 'BAIXO' END AS potencial_crosssell
  FROM m
)
SELECT *,
  faturamento_total / NULLIF(relacionamento_dias, 0) * 365 * 2 AS ltv_estimado,
  CAST(score_reativacao * 0.4 + CASE categoria_valor WHEN 'PREMIUM' THEN 100 WHEN 'ALTO_VALOR' THEN 80
       WHEN 'MEDIO_VALOR' THEN 60 ELSE 40 END * 0.6 AS DOUBLE) AS score_oportunidade
FROM c"""

GEO_EXPANSION = "WITH " + INV + f""",
g AS (
  SELECT tomador_uf, tomador_municipio,
    COUNT(DISTINCT tomador_cnpj) AS total_clientes,
    COUNT(*) AS total_nfses,
    CAST(SUM(valor_liquido) AS DOUBLE) AS faturamento_total,
    CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(valor_liquido) AS ticket_medio_local,
    COUNT(DISTINCT CASE WHEN data_emissao >= {AS_OF} - INTERVAL 12 MONTH THEN tomador_cnpj END) AS clientes_ultimos_12m,
    CAST(SUM(CASE WHEN data_emissao >= {AS_OF} - INTERVAL 12 MONTH THEN valor_liquido ELSE 0 END) AS DOUBLE) AS faturamento_12m,
    COUNT(DISTINCT tomador_cnpj) / NULLIF(COUNT(DISTINCT tomador_municipio), 0) AS densidade_clientes_municipio
  FROM inv WHERE tomador_uf IS NOT NULL
  GROUP BY 1, 2
),
p AS (
  SELECT *,
    CASE WHEN faturamento_total >= 100000 AND total_clientes >= 10 THEN 'MERCADO_MADURO'
         WHEN faturamento_total >= 50000 AND total_clientes >= 5 THEN 'OPORTUNIDADE_ALTA'
         WHEN faturamento_total >= 20000 AND total_clientes >= 3 THEN 'OPORTUNIDADE_MEDIA'
         WHEN total_clientes >= 1 THEN 'MERCADO_EMERGENTE' ELSE 'NAO_ATENDIDO' END AS classificacao_mercado,
    faturamento_12m / NULLIF(clientes_ultimos_12m, 0) * 10 AS roi_estimado_expansao
  FROM g
)
SELECT *,
  ROW_NUMBER() OVER (ORDER BY CASE classificacao_mercado WHEN 'OPORTUNIDADE_ALTA' THEN 4
      WHEN 'OPORTUNIDADE_MEDIA' THEN 3 WHEN 'MERCADO_EMERGENTE' THEN 2 WHEN 'MERCADO_MADURO' THEN 1 ELSE 0 END DESC,
    roi_estimado_expansao DESC NULLS LAST, tomador_uf ASC, tomador_municipio ASC NULLS FIRST) AS prioridade_expansao
FROM p"""

EXECUTIVE_KPIS = "WITH " + INV + f""",
b AS (
  SELECT year(data_emissao) AS ano, month(data_emissao) AS mes,
    COUNT(*) AS nfses_emitidas,
    COUNT(DISTINCT tomador_cnpj) AS clientes_unicos,
    SUM(valor_liquido) AS rec_d,
    CAST(SUM(valor_liquido) AS DOUBLE) AS receita_liquida,
    CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(valor_liquido) AS ticket_medio,
    CAST(SUM(valor_pis + valor_cofins + valor_inss + valor_ir + valor_csll) AS DOUBLE) AS impostos_retidos,
    CAST(SUM(valor_iss) AS DOUBLE) AS iss_total,
    COUNT(DISTINCT item_lista_servico) AS tipos_servico
  FROM inv GROUP BY 1, 2
),
k AS (
  SELECT *,
    LAG(receita_liquida) OVER w AS receita_mes_anterior,
    LAG(clientes_unicos) OVER w AS clientes_mes_anterior,
    CAST(SUM(rec_d) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
      / COUNT(rec_d) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS receita_media_movel_3m
  FROM b
  WINDOW w AS (ORDER BY ano ASC NULLS FIRST, mes ASC NULLS FIRST)
),
k2 AS (
  SELECT *, {rha('((receita_liquida - receita_mes_anterior) / NULLIF(receita_mes_anterior, 0)) * 100')} AS growth_rate_receita
  FROM k
)
SELECT ano, mes, nfses_emitidas, clientes_unicos, receita_liquida, ticket_medio, impostos_retidos,
  iss_total, tipos_servico, receita_mes_anterior, clientes_mes_anterior, growth_rate_receita,
  receita_media_movel_3m,
  CASE WHEN growth_rate_receita >= 20 THEN 'EXCELENTE' WHEN growth_rate_receita >= 10 THEN 'BOM'
       WHEN growth_rate_receita >= 0 THEN 'ESTAVEL' ELSE 'DECLINIO' END AS performance_classificacao,
  receita_liquida * 0.15 AS meta_recuperacao_tributaria,
  {rha('(impostos_retidos / NULLIF(receita_liquida, 0)) * 100')} AS eficiencia_tributaria_pct
FROM k2"""

SALES_OPPORTUNITIES = "WITH " + INV + f""",
s AS (
  SELECT tomador_cnpj, tomador_razao_social, tomador_uf,
    COUNT(DISTINCT item_lista_servico) AS tipos_servicos_utilizados,
    string_agg(DISTINCT item_lista_servico, ',' ORDER BY item_lista_servico) AS lista_servicos,
    CAST(SUM(valor_liquido) AS DOUBLE) AS valor_total_cliente,
    COUNT(*) AS total_servicos,
    MAX(data_emissao) AS ultimo_servico,
    COUNT(DISTINCT CONCAT(year(data_emissao), '-', month(data_emissao))) AS meses_ativos,
    CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(valor_liquido) AS ticket_medio_cliente
  FROM inv WHERE tomador_cnpj IS NOT NULL
  GROUP BY 1, 2, 3
),
o AS (
  SELECT *,
    CASE WHEN valor_total_cliente >= 50000 AND meses_ativos >= 12 THEN 100
         WHEN valor_total_cliente >= 20000 AND meses_ativos >= 6 THEN 80
         WHEN valor_total_cliente >= 10000 AND meses_ativos >= 3 THEN 60
         WHEN valor_total_cliente >= 5000 THEN 40 ELSE 20 END AS score_upsell,
    CASE WHEN tipos_servicos_utilizados = 1 THEN 100 WHEN tipos_servicos_utilizados = 2 THEN 70
         WHEN tipos_servicos_utilizados = 3 THEN 50 ELSE 30 END AS score_crosssell,
    CASE WHEN date_diff('day', ultimo_servico, {AS_OF}) <= 30 THEN 'URGENTE'
         WHEN date_diff('day', ultimo_servico, {AS_OF}) <= 90 THEN 'ALTA'
         WHEN date_diff('day', ultimo_servico, {AS_OF}) <= 180 THEN 'MEDIA' ELSE 'BAIXA' END AS prioridade_acao,
    ticket_medio_cliente * 3 AS potencial_receita_adicional
  FROM s
)
SELECT *,
  CAST(score_upsell * 0.6 + score_crosssell * 0.4 AS DOUBLE) AS score_oportunidade_final,
  CASE WHEN score_crosssell >= 80 AND score_upsell >= 60 THEN 'CROSS_SELL_PRIORITARIO'
       WHEN score_upsell >= 80 THEN 'UP_SELL_PRIORITARIO'
       WHEN score_crosssell >= 60 THEN 'CROSS_SELL_SECUNDARIO'
       WHEN prioridade_acao = 'URGENTE' THEN 'RETENCAO_URGENTE' ELSE 'MANUTENCAO' END AS recomendacao_acao
FROM o
ORDER BY score_oportunidade_final DESC"""

TAX_RECOVERY = "WITH " + INV + f""",
a AS (
  SELECT tomador_cnpj, tomador_razao_social, tomador_uf,
    CAST(SUM(valor_servicos) AS DOUBLE) AS valor_servicos_total,
    CAST(SUM(valor_liquido) AS DOUBLE) AS valor_liquido_total,
    CAST(SUM(valor_pis) AS DOUBLE) AS total_pis,
    CAST(SUM(valor_cofins) AS DOUBLE) AS total_cofins,
    CAST(SUM(valor_inss) AS DOUBLE) AS total_inss,
    CAST(SUM(valor_ir) AS DOUBLE) AS total_ir,
    CAST(SUM(valor_csll) AS DOUBLE) AS total_csll,
    CAST(SUM(valor_iss) AS DOUBLE) AS total_iss,
    CAST(SUM(valor_deducoes) AS DOUBLE) AS total_deducoes,
    CAST(SUM(valor_pis + valor_cofins + valor_inss + valor_ir + valor_csll) AS DOUBLE) AS impostos_federais_retidos,
    COUNT(*) AS total_nfses,
    MAX(data_emissao) AS ultima_nfse
  FROM inv WHERE tomador_cnpj IS NOT NULL
  GROUP BY 1, 2, 3
)
SELECT *,
  impostos_federais_retidos * 1.2 AS potencial_recuperacao_estimado,
  {rha('(impostos_federais_retidos / NULLIF(valor_servicos_total, 0)) * 100')} AS taxa_retencao_pct,
  CASE WHEN impostos_federais_retidos >= 10000 THEN 'ALTO_POTENCIAL'
       WHEN impostos_federais_retidos >= 5000 THEN 'MEDIO_POTENCIAL'
       WHEN impostos_federais_retidos >= 1000 THEN 'BAIXO_POTENCIAL' ELSE 'SEM_POTENCIAL' END AS classificacao_recuperacao,
  impostos_federais_retidos * 0.30 AS honorarios_estimados,
  CASE WHEN impostos_federais_retidos >= 10000 AND date_diff('day', ultima_nfse, {AS_OF}) <= 90 THEN 100
       WHEN impostos_federais_retidos >= 5000 AND date_diff('day', ultima_nfse, {AS_OF}) <= 180 THEN 80
       WHEN impostos_federais_retidos >= 1000 AND date_diff('day', ultima_nfse, {AS_OF}) <= 365 THEN 60
       ELSE 30 END AS score_prioridade_recuperacao
FROM a
ORDER BY impostos_federais_retidos DESC"""

ORACLES: dict[str, str] = {
    "customer_performance": CUSTOMER_PERFORMANCE,
    "geo_expansion": GEO_EXPANSION,
    "executive_kpis": EXECUTIVE_KPIS,
    "sales_opportunities": SALES_OPPORTUNITIES,
    "tax_recovery": TAX_RECOVERY,
}


# ------------------------------------------------------------- staging / marts
# Expected staging rows, stated directly from the source tables (the adapter's
# documents carry known keys), so the Spark document parsing is checked.
STG_BILLING = BASE + """,
stg_billing AS (
  SELECT
    'Faturamento ' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS arquivo_nome,
    'Sheet' || CAST(l_linenumber % 2 + 1 AS VARCHAR) AS aba_nome,
    l_orderkey * 8 + l_linenumber AS linha_original,
    c_name AS cliente,
    CAST(l_shipdate AS DATE) AS data_emissao,
    COALESCE(cnpj_, '') AS cnpj,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS numero_nota,
    CAST(vl_c AS DOUBLE) / 100 AS valor_liquido,
    CAST(vs_c AS DOUBLE) / 100 AS valor_bruto,
    CAST(pis_c AS DOUBLE) / 100 AS honorarios,
    item_ AS tipo_servico,
    o_orderstatus AS situacao,
    'C' || CAST(c_custkey % 10 AS VARCHAR) AS consultor,
    CAST(o_orderdate AS TIMESTAMP) AS _ingestion_timestamp,
    'b' || CAST(year(l_shipdate) AS VARCHAR) AS _ingestion_batch_id
  FROM cents2
  WHERE l_orderkey % 3 IN (0, 1) AND l_orderkey % 10 <> 0 AND l_orderkey % 13 <> 0
)"""

STG_COMPANIES = """
cv AS (
  SELECT c.c_custkey AS ck, c.c_name, n.n_name, v
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey,
       (SELECT unnest([0, 1]) AS v) vv
  WHERE c.c_custkey % 41 <> 0
),
stg_companies AS (
  SELECT
    'Empresas Antigas v' || CAST(v AS VARCHAR) || '.xlsx' AS arquivo_nome,
    ck AS linha_original,
    CASE WHEN ck % 97 = 0 THEN '' ELSE lpad(CAST(ck AS VARCHAR), 14, '0') END AS cnpj,
    CASE WHEN v = 0 THEN c_name || ' (antigo)' WHEN ck % 6 = 0 THEN NULL ELSE c_name END AS razao_social,
    CASE WHEN v = 1 AND ck % 7 = 0 THEN NULL ELSE 'F' || CAST(ck AS VARCHAR) END AS nome_fantasia,
    CASE WHEN v = 0 THEN 'ATIVA' ELSE ['ATIVA', 'INAPTA', 'BAIXADA'][ck % 3 + 1] END AS situacao_cadastral,
    CASE WHEN ck % 19 = 0 THEN NULL ELSE make_date(2000, CAST(ck % 12 + 1 AS INTEGER), CAST(ck % 28 + 1 AS INTEGER)) END AS data_situacao,
    CASE ck % 5
      WHEN 0 THEN 'Rua A, 10, ' || n_name || '-' || CAST(ck % 10 AS VARCHAR) || '/' || n_name
      WHEN 1 THEN 'Rua A 10 ' || n_name || '-' || CAST(ck % 10 AS VARCHAR) || ' ' || n_name
      WHEN 2 THEN 'Rua B, 20, ' || n_name || '-' || CAST(ck % 10 AS VARCHAR)
      WHEN 3 THEN 'Rua C, 30, ' || n_name || '-' || CAST(ck % 10 AS VARCHAR) || '/' || n_name || chr(10)
      ELSE 'Caixa Postal 1' END AS endereco,
    CASE WHEN ck % 5 IN (0, 2, 3) THEN n_name || '-' || CAST(ck % 10 AS VARCHAR) END AS cidade_,
    CASE WHEN ck % 5 IN (0, 3) THEN n_name END AS uf_,
    (CASE WHEN v = 0 THEN TIMESTAMP '2001-01-01 00:00:00' ELSE TIMESTAMP '2001-06-01 00:00:00' END)
      + to_seconds(ck) AS _ingestion_timestamp,
    v
  FROM cv
  WHERE (ck * 2 + v) % 23 <> 0 AND (ck + v) % 29 <> 0
)"""

DIM = STG_BILLING + "," + STG_COMPANIES + f""",
e AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY cnpj ORDER BY _ingestion_timestamp DESC,
                                 arquivo_nome DESC, linha_original DESC) AS rn
    FROM stg_companies WHERE cnpj IS NOT NULL AND cnpj <> '') WHERE rn = 1
),
f AS (
  SELECT cnpj, MIN(data_emissao) AS primeira_nota, MAX(data_emissao) AS ultima_nota,
         COUNT(*) AS total_notas,
         CAST(SUM(CAST(valor_liquido AS DECIMAL(38,9))) AS DOUBLE) AS faturamento_total,
         CAST(SUM(CAST(valor_liquido AS DECIMAL(38,9))) AS DOUBLE) / COUNT(valor_liquido) AS ticket_medio
  FROM stg_billing WHERE cnpj IS NOT NULL AND cnpj <> ''
  GROUP BY cnpj
),
dim AS (
  SELECT
    ROW_NUMBER() OVER (ORDER BY COALESCE(f.faturamento_total, 0) DESC, COALESCE(e.cnpj, f.cnpj) ASC) AS cliente_key,
    COALESCE(e.cnpj, f.cnpj) AS cnpj,
    COALESCE(e.razao_social, 'Nome não identificado') AS razao_social,
    e.nome_fantasia, e.situacao_cadastral, e.data_situacao, e.endereco,
    e.cidade_ AS cidade, e.uf_ AS uf,
    f.primeira_nota, f.ultima_nota, f.total_notas, f.faturamento_total, f.ticket_medio,
    CASE WHEN f.ultima_nota >= {AS_OF} - INTERVAL 12 MONTH THEN 'ATIVO'
         WHEN f.ultima_nota >= {AS_OF} - INTERVAL 24 MONTH THEN 'INATIVO_RECENTE'
         WHEN f.ultima_nota >= {AS_OF} - INTERVAL 36 MONTH THEN 'INATIVO_MEDIO'
         WHEN f.ultima_nota IS NOT NULL THEN 'INATIVO_ANTIGO' ELSE 'SEM_NOTAS' END AS status_cliente,
    date_diff('day', f.ultima_nota, {AS_OF}) AS dias_sem_nota,
    CASE WHEN f.faturamento_total > 50000 THEN 'VIP' WHEN f.faturamento_total > 20000 THEN 'PREMIUM'
         WHEN f.faturamento_total > 5000 THEN 'STANDARD' ELSE 'LOW_TICKET' END AS segmento_valor
  FROM e FULL OUTER JOIN f ON e.cnpj = f.cnpj
  WHERE COALESCE(e.cnpj, f.cnpj) IS NOT NULL
)"""

STAGING_BILLING = "WITH " + STG_BILLING + " SELECT * FROM stg_billing"
STAGING_COMPANIES = ("WITH " + STG_COMPANIES +
                     " SELECT * EXCLUDE (cidade_, uf_, v) FROM stg_companies")
DIM_CUSTOMERS = "WITH " + DIM + " SELECT * FROM dim"
FACT_BILLING = "WITH " + DIM + """
SELECT b.cnpj, d.cliente_key, b.data_emissao, strftime(b.data_emissao, '%Y%m%d') AS data_key,
  b.numero_nota, b.tipo_servico, b.situacao, b.valor_liquido, b.valor_bruto, b.honorarios, b.consultor,
  year(b.data_emissao) AS ano, month(b.data_emissao) AS mes, quarter(b.data_emissao) AS trimestre,
  b.arquivo_nome AS source_file, b._ingestion_timestamp, b._ingestion_batch_id
FROM stg_billing b LEFT JOIN dim d ON b.cnpj = d.cnpj"""
CUSTOMER_SUMMARY = "WITH " + DIM + """
SELECT status_cliente, segmento_valor, COUNT(*) AS total_clientes,
  CAST(SUM(CAST(faturamento_total AS DECIMAL(38,9))) AS DOUBLE) AS faturamento_total,
  CAST(SUM(CAST(sign(ticket_medio) * floor(abs(ticket_medio) * 1000000 + 0.5) / 1000000 AS DECIMAL(38,6))) AS DOUBLE)
    / COUNT(ticket_medio) AS ticket_medio,
  AVG(dias_sem_nota) AS media_dias_sem_nota
FROM dim GROUP BY status_cliente, segmento_valor
ORDER BY status_cliente, segmento_valor"""

DIM_CALENDAR = """
WITH b AS (
  SELECT least(COALESCE(MIN(CAST(l_shipdate AS DATE)), DATE '2006-01-01'), DATE '2006-01-01') AS s,
         greatest(COALESCE(MAX(CAST(l_shipdate AS DATE)), DATE '2030-12-31'), DATE '2030-12-31') AS e
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS data FROM b)
SELECT strftime(data, '%Y%m%d') AS data_key, data, year(data) AS ano, quarter(data) AS trimestre,
  month(data) AS mes, strftime(data, '%B') AS nome_mes, CAST(strftime(data, '%U') AS BIGINT) AS semana,
  dayofweek(data) + 1 AS dia_semana, strftime(data, '%A') AS nome_dia_semana,
  dayofweek(data) + 1 IN (1, 7) AS eh_fim_de_semana
FROM d"""

INGESTION_STATUS = "WITH " + BASE + "," + STG_COMPANIES + """,
raw AS (
  SELECT CASE l_orderkey % 3 WHEN 0 THEN 'faturamento_historico' WHEN 1 THEN 'clientes_atuais'
              ELSE 'generico' END AS arquivo_tipo,
         CASE WHEN l_orderkey % 10 = 0 THEN 'pending' ELSE 'processed' END AS _processing_status,
         'Faturamento ' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS arquivo_nome,
         CASE WHEN l_linenumber % 4 = 3 AND l_orderkey % 7 = 0 THEN CAST(l_shipdate AS DATE) END AS data_emissao,
         CAST(NULL AS DOUBLE) AS valor
  FROM cents2
  UNION ALL
  SELECT CASE WHEN (ck * 2 + v) % 23 = 0 THEN 'generico'
              WHEN ck % 2 = 0 THEN 'empresas_antigas' ELSE 'desconhecido' END,
         CASE WHEN (ck + v) % 29 = 0 THEN 'pending' ELSE 'processed' END,
         'Empresas Antigas v' || CAST(v AS VARCHAR) || '.xlsx', CAST(NULL AS DATE), CAST(NULL AS DOUBLE)
  FROM cv
)
SELECT arquivo_tipo, _processing_status, COUNT(*) AS total_linhas,
  COUNT(DISTINCT arquivo_nome) AS total_arquivos, MIN(data_emissao) AS data_mais_antiga,
  MAX(data_emissao) AS data_mais_recente,
  CAST(SUM(CAST(valor AS DECIMAL(38,9))) AS DOUBLE) AS valor_total
FROM raw GROUP BY arquivo_tipo, _processing_status ORDER BY arquivo_tipo, _processing_status"""

ORACLES.update({
    "staging_billing": STAGING_BILLING,
    "staging_companies": STAGING_COMPANIES,
    "dim_customers": DIM_CUSTOMERS,
    "fact_billing": FACT_BILLING,
    "dim_calendar": DIM_CALENDAR,
    "ingestion_status": INGESTION_STATUS,
    "customer_summary": CUSTOMER_SUMMARY,
})


# ------------------------------------------------------------- XML / loading
_MONEY_D = """CAST(vs_c AS DOUBLE) / 100 AS valor_servicos, CAST(ded_c AS DOUBLE) / 100 AS valor_deducoes,
    CAST(pis_c AS DOUBLE) / 100 AS valor_pis, CAST(cofins_c AS DOUBLE) / 100 AS valor_cofins,
    CAST(COALESCE(inss_c, 0) AS DOUBLE) / 100 AS valor_inss, CAST(ir_c AS DOUBLE) / 100 AS valor_ir,
    CAST(csll_c AS DOUBLE) / 100 AS valor_csll,
    CAST(CASE WHEN l_linenumber = 3 THEN 0 ELSE iss_c END AS DOUBLE) / 100 AS valor_iss,
    CAST(vl_c AS DOUBLE) / 100 AS valor_liquido"""

XML_INVOICES = "WITH " + BASE + f"""
SELECT
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS numero_nfse,
  lpad(CAST((l_orderkey * 31 + l_linenumber * 7) % 1000000000 AS VARCHAR), 9, '0') AS codigo_verificacao,
  CAST(l_shipdate AS DATE) AS data_emissao,
  CAST(o_orderdate AS DATE) AS data_competencia,
  '11222333000181' AS prestador_cnpj, 'Prestador Exemplo Ltda' AS prestador_razao_social,
  cnpj_ AS tomador_cnpj,
  CASE WHEN cnpj_ IS NULL THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS tomador_cpf, c_name AS tomador_razao_social,
  'Rua ' || CAST(c_custkey % 100 AS VARCHAR) AS tomador_endereco, city_ AS tomador_municipio,
  n_name AS tomador_uf, lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0') AS tomador_cep,
  {_MONEY_D},
  'Servico ' || item_ AS discriminacao, item_ AS item_lista_servico,
  {AS_OF} AS data_processamento, 'nfse_api' AS origem_consulta,
  sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)
         || lpad(CAST((l_orderkey * 31 + l_linenumber * 7) % 1000000000 AS VARCHAR), 9, '0')
         || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')
         || CASE WHEN l_linenumber % 4 = 0 THEN 'T23:30:00-03:00' WHEN l_linenumber % 2 = 0 THEN 'T10:30:00'
                 ELSE '' END) AS hash_nfse
FROM cents2
WHERE l_orderkey % 101 <> 0"""

XML_SALVAGED = "WITH " + BASE + """
SELECT
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS numero_nfse,
  CAST(l_shipdate AS DATE) AS data_emissao, cnpj_ AS tomador_cnpj,
  CASE WHEN cnpj_ IS NULL THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS tomador_cpf, c_name AS tomador_razao_social,
  CASE WHEN l_orderkey % 11 = 0 THEN '</CompNfse> <p:' ELSE '' END || 'Servico ' || item_ AS discriminacao,
  CAST(vl_c AS DOUBLE) / 100 AS valor_liquido,
  sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)
         || lpad(CAST((l_orderkey * 31 + l_linenumber * 7) % 1000000000 AS VARCHAR), 9, '0')
         || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')
         || CASE WHEN l_linenumber % 4 = 0 THEN 'T23:30:00-03:00' WHEN l_linenumber % 2 = 0 THEN 'T10:30:00'
                 ELSE '' END) AS hash_nfse
FROM cents2
QUALIFY l_orderkey % 13 <> 0 OR row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, numero_nfse || '<' DESC) > 1"""

XML_QUARANTINE = "WITH " + BASE + """
SELECT DISTINCT l_orderkey AS documento_id, 'xml malformado' AS erro FROM cents2 WHERE l_orderkey % 101 = 0"""

_INV_FULL = """
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS numero_nfse,
    lpad(CAST((l_orderkey * 31 + l_linenumber * 7) % 1000000000 AS VARCHAR), 9, '0') AS codigo_verificacao,
    CAST(l_shipdate AS DATE) AS data_emissao, CAST(o_orderdate AS DATE) AS data_competencia,
    '11222333000181' AS prestador_cnpj, 'Prestador Exemplo Ltda' AS prestador_razao_social,
    cnpj_ AS tomador_cnpj, CAST(NULL AS VARCHAR) AS tomador_cpf, c_name AS tomador_razao_social,
    'Rua ' || CAST(c_custkey % 100 AS VARCHAR) || ', ' || CAST(c_custkey AS VARCHAR) || ', '
      || COALESCE(city_, 'Centro') || '/' || n_name AS tomador_endereco,
    city_ AS tomador_municipio, n_name AS tomador_uf,
    lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0') AS tomador_cep,
    vs_c, ded_c, pis_c, cofins_c, inss_c, ir_c, csll_c, iss_c, vl_c,
    'Servico ' || item_ AS discriminacao, item_ AS item_lista_servico"""

INSERT_IF_ABSENT = "WITH " + BASE + f""",
batch AS (
  SELECT *, sha256(numero_nfse || codigo_verificacao || strftime(data_emissao, '%Y-%m-%d')) AS hash_nfse
  FROM (SELECT {_INV_FULL} FROM cents2)
),
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY hash_nfse ORDER BY
      numero_nfse, codigo_verificacao, data_emissao, data_competencia, prestador_cnpj,
      prestador_razao_social, tomador_cnpj NULLS FIRST, tomador_cpf NULLS FIRST, tomador_razao_social,
      tomador_endereco, tomador_municipio NULLS FIRST, tomador_uf, tomador_cep, vs_c, ded_c, pis_c,
      cofins_c, inss_c NULLS FIRST, ir_c, csll_c, iss_c, vl_c) AS rn
    FROM batch) WHERE rn = 1
),
previous AS (SELECT DISTINCT hash_nfse FROM batch WHERE data_emissao < DATE '1999-01-01')
SELECT numero_nfse, codigo_verificacao, data_emissao, data_competencia, prestador_cnpj,
  prestador_razao_social, tomador_cnpj, tomador_cpf, tomador_razao_social, tomador_endereco,
  tomador_municipio, tomador_uf, tomador_cep,
  CAST(vs_c AS DOUBLE) / 100 AS valor_servicos, CAST(ded_c AS DOUBLE) / 100 AS valor_deducoes,
  CAST(pis_c AS DOUBLE) / 100 AS valor_pis, CAST(cofins_c AS DOUBLE) / 100 AS valor_cofins,
  CAST(inss_c AS DOUBLE) / 100 AS valor_inss, CAST(ir_c AS DOUBLE) / 100 AS valor_ir,
  CAST(csll_c AS DOUBLE) / 100 AS valor_csll, CAST(iss_c AS DOUBLE) / 100 AS valor_iss,
  CAST(vl_c AS DOUBLE) / 100 AS valor_liquido,
  discriminacao, item_lista_servico, {AS_OF} AS data_processamento, 'adapter' AS origem_consulta, hash_nfse
FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM previous p WHERE p.hash_nfse = f.hash_nfse)"""

COVERAGE_GAPS = "WITH " + INV + f""",
plan AS (
  SELECT j AS janela, CAST({AS_OF} - 720 + CAST(31 * j AS INTEGER) AS DATE) AS inicio
  FROM (SELECT unnest(range(0, 720 // 31 + 1)) AS j)
),
plan2 AS (SELECT janela, inicio, least(CAST(inicio + 30 AS DATE), {AS_OF}) AS fim FROM plan WHERE inicio < {AS_OF}),
counts AS (
  SELECT date_diff('day', CAST({AS_OF} - 720 AS DATE), data_emissao) // 31 AS janela, COUNT(*) AS notas
  FROM inv WHERE data_emissao >= CAST({AS_OF} - 720 AS DATE) AND data_emissao <= {AS_OF}
  GROUP BY 1
)
SELECT p.janela, p.inicio, p.fim, COALESCE(c.notas, 0) AS notas, c.notas IS NULL AS lacuna
FROM plan2 p LEFT JOIN counts c ON p.janela = c.janela"""

ORACLES.update({
    "xml_invoices": XML_INVOICES,
    "xml_quarantine": XML_QUARANTINE,
    "xml_salvaged": XML_SALVAGED,
    "insert_if_absent": INSERT_IF_ABSENT,
    "coverage_gaps": COVERAGE_GAPS,
})


# ------------------------------------------------------------- scoring / quality
from .. import config as _C  # noqa: E402


# FIXED VALUES — the public check-digit weights, stated here again so that a wrong
# constant in the engine does not pass its own check.
CNPJ_WEIGHTS_1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_WEIGHTS_2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_WEIGHTS_1 = (10, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_WEIGHTS_2 = (11, 10, 9, 8, 7, 6, 5, 4, 3, 2)


def _dv(col: str, weights) -> str:
    s = " + ".join(f"CAST(substr({col}, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights))
    return f"(CASE WHEN ({s}) % 11 < 2 THEN 0 ELSE 11 - ({s}) % 11 END)"


def _valid(col: str, n: int, w1, w2) -> str:
    return (f"COALESCE(regexp_full_match({col}, '[0-9]{{{n}}}') AND {col} <> repeat(substr({col}, 1, 1), {n}) "
            f"AND {_dv(col, w1)} = CAST(substr({col}, {len(w1) + 1}, 1) AS INTEGER) "
            f"AND {_dv(col, w2)} = CAST(substr({col}, {len(w2) + 1}, 1) AS INTEGER), false)")


CNPJ_VALID = "WITH " + INV + f""",
d AS (SELECT regexp_replace(tomador_cnpj, '[^0-9]', '', 'g') AS documento FROM inv WHERE tomador_cnpj IS NOT NULL)
SELECT documento, COUNT(*) AS ocorrencias, {_valid('documento', 14, CNPJ_WEIGHTS_1, CNPJ_WEIGHTS_2)} AS valido
FROM d GROUP BY documento"""

CPF_VALID = f"""
WITH d AS (SELECT lpad(CAST(c_custkey * 104729 % 100000000000 AS VARCHAR), 11, '0') AS documento FROM customer)
SELECT documento, COUNT(*) AS ocorrencias, {_valid('documento', 11, CPF_WEIGHTS_1, CPF_WEIGHTS_2)} AS valido
FROM d GROUP BY documento"""

SCORED = DIM + """,
sc AS (
  SELECT cnpj, razao_social, situacao_cadastral, status_cliente, total_notas, faturamento_total, ultima_nota,
    (CASE situacao_cadastral WHEN 'ATIVA' THEN 40 WHEN 'INAPTA' THEN 20 ELSE 0 END
     + CASE WHEN COALESCE(faturamento_total, 0) >= 1000000 THEN 30 WHEN COALESCE(faturamento_total, 0) >= 500000 THEN 25
            WHEN COALESCE(faturamento_total, 0) >= 200000 THEN 20 ELSE 0 END
     + CASE WHEN COALESCE(total_notas, 0) >= 50 THEN 20 WHEN COALESCE(total_notas, 0) >= 20 THEN 15 ELSE 0 END) AS score_cliente
  FROM dim
),
sc2 AS (
  SELECT *,
    CASE WHEN score_cliente >= 80 AND COALESCE(faturamento_total, 0) >= 1000000 THEN 'OPORTUNIDADE_PREMIUM'
         WHEN score_cliente >= 60 AND COALESCE(faturamento_total, 0) >= 500000 THEN 'OPORTUNIDADE_ALTA'
         WHEN score_cliente >= 40 AND COALESCE(faturamento_total, 0) >= 100000 THEN 'OPORTUNIDADE_MÉDIA'
         WHEN status_cliente = 'ATIVO' THEN 'CLIENTE_ATIVO_BAIXO_POTENCIAL'
         WHEN ultima_nota IS NOT NULL THEN 'CLIENTE_INATIVO_RECUPERÁVEL' ELSE 'SEM_HISTORICO' END AS classificacao_cliente
  FROM sc
),
sc3 AS (
  SELECT * EXCLUDE (ultima_nota),
    CASE WHEN COALESCE(faturamento_total, 0) >= 1000000 THEN 'CONTATO_IMEDIATO_PREMIUM'
         WHEN COALESCE(faturamento_total, 0) >= 500000 THEN 'CONTATO_PRIORITARIO'
         WHEN COALESCE(faturamento_total, 0) >= 100000 THEN 'INCLUIR_CAMPANHA_COMERCIAL'
         WHEN classificacao_cliente = 'CLIENTE_INATIVO_RECUPERÁVEL' THEN 'CAMPANHA_REATIVACAO'
         ELSE 'MONITORAR' END AS acao_recomendada
  FROM sc2
)"""

CLIENT_SCORE = "WITH " + SCORED + " SELECT * FROM sc3"
TOP_OPPORTUNITIES = "WITH " + SCORED.replace(
    "  FROM dim\n", "  FROM (SELECT * REPLACE (faturamento_total * 1000 AS faturamento_total) FROM dim)\n") + """
SELECT cnpj, razao_social, score_cliente, faturamento_total, classificacao_cliente FROM sc3
WHERE classificacao_cliente IN ('OPORTUNIDADE_PREMIUM', 'OPORTUNIDADE_ALTA')
ORDER BY faturamento_total DESC, cnpj"""

VALIDATION_PROGRESS = "WITH " + STG_COMPANIES + f""",
ok AS (
  SELECT CASE WHEN v = 0 THEN c_name || ' (antigo)' WHEN ck % 6 = 0 THEN NULL ELSE c_name END AS razao_social
  FROM cv
  WHERE (ck * 2 + v) % 23 <> 0 AND ck % 2 = 0 AND (ck + v) % 29 <> 0 AND ck % 5 <> 0
),
a AS (SELECT COUNT(*) AS total, COUNT(razao_social) AS validados FROM ok)
SELECT total, validados,
  sign(CAST(validados AS DOUBLE) * 100 / total) * floor(abs(CAST(validados AS DOUBLE) * 100 / total) * 10 + 0.5) / 10
    AS percentual
FROM a"""

PENDING_VALIDATION = "WITH " + DIM + """
SELECT cnpj, razao_social, faturamento_total, total_notas FROM dim
WHERE cnpj NOT IN (SELECT cnpj FROM e WHERE situacao_cadastral IS NOT NULL)
ORDER BY COALESCE(faturamento_total, 0) DESC, cnpj
LIMIT 150"""

def _validation_days_sql(days: int) -> str:
    """Each day's lot from the lots before it."""
    out, sofar = "", "SELECT NULL::VARCHAR AS cnpj, NULL::DATE AS data_tentativa WHERE false"
    for i in range(1, days + 1):
        out += f""",
a{i} AS (SELECT cnpj, COUNT(*) AS n, MAX(data_tentativa) AS ultima FROM ({sofar}) GROUP BY cnpj),
d{i} AS (
  SELECT p.cnpj, DATE '2024-03-0{i}' AS data_tentativa, COALESCE(n, 0) + 1 AS tentativa
  FROM pend p LEFT JOIN a{i} a ON a.cnpj = p.cnpj
  WHERE n IS NULL OR (right(p.cnpj, 1) NOT IN ('0', '2', '4', '6', '8') AND ultima + CAST(LEAST(pow(2, n - 1), 30) AS INTEGER) <= DATE '2024-03-0{i}')
  ORDER BY COALESCE(n, 0), COALESCE(faturamento_total, 0) DESC, p.cnpj LIMIT 150)"""
        sofar += f" UNION ALL SELECT cnpj, data_tentativa FROM d{i}"
    every = " UNION ALL ".join(f"SELECT * FROM d{i}" for i in range(1, days + 1))
    return "WITH " + DIM + """,
pend AS (SELECT cnpj, faturamento_total FROM dim WHERE cnpj NOT IN (SELECT cnpj FROM e WHERE situacao_cadastral IS NOT NULL))""" + out + f"""
SELECT *, CASE WHEN right(cnpj, 1) IN ('0', '2', '4', '6', '8') THEN 'ATIVA' END AS situacao_cadastral FROM ({every})"""


VALIDATION_DAYS = _validation_days_sql(3)

UNPIVOT_TAXES = "WITH " + INV + """,
t AS (
  SELECT numero_nfse, 'PIS' AS tipo_tributo, valor_pis AS valor FROM inv
  UNION ALL SELECT numero_nfse, 'COFINS', valor_cofins FROM inv
  UNION ALL SELECT numero_nfse, 'INSS', valor_inss FROM inv
  UNION ALL SELECT numero_nfse, 'IR', valor_ir FROM inv
  UNION ALL SELECT numero_nfse, 'CSLL', valor_csll FROM inv
  UNION ALL SELECT numero_nfse, 'ISS', valor_iss FROM inv
)
SELECT numero_nfse, tipo_tributo, CAST(valor AS DOUBLE) AS valor FROM t WHERE valor IS NOT NULL"""

ORPHAN_TAXES = UNPIVOT_TAXES.replace("FROM t WHERE valor IS NOT NULL",
                                     "FROM t WHERE valor IS NOT NULL AND CAST(split_part(numero_nfse, '-', 1) AS BIGINT) % 101 = 0")

RPS = """
l1 AS (
  SELECT l_orderkey, l_partkey, l_suppkey FROM (
    SELECT l_orderkey, l_partkey, l_suppkey,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey) AS rn
    FROM lineitem WHERE l_linenumber = 1) WHERE rn = 1
),
rb AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_orderdate, l1.l_partkey, l1.l_suppkey,
         1 + o.o_orderkey % 3 AS n, unnest(range(1, 2 + o.o_orderkey % 3)) AS tentativa
  FROM orders o LEFT JOIN l1 ON o.o_orderkey = l1.l_orderkey
),
rps AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS rps_numero, 'A' AS rps_serie,
    CASE WHEN o_orderkey % 47 = 0 THEN '4' ELSE '1' END AS rps_tipo,
    CAST(o_orderdate AS TIMESTAMP) + tentativa * INTERVAL 1 HOUR AS data_envio,
    CASE WHEN tentativa < n THEN CASE WHEN o_orderkey % 53 = 0 THEN 'PENDENTE' ELSE 'ERRO' END
         WHEN o_orderstatus = 'F' THEN 'SUCESSO' WHEN o_orderstatus = 'O' THEN 'ERRO' ELSE 'PROCESSANDO' END AS status,
    o_orderkey, l_partkey, l_suppkey, tentativa,
    CAST(o_orderkey % 50 + tentativa AS DECIMAL(10,2)) AS tempo
  FROM rb
),
rps2 AS (
  SELECT *, CASE WHEN status = 'SUCESSO' THEN concat_ws('-', o_orderkey, 1, l_partkey, l_suppkey) END AS numero_nfse_gerado
  FROM rps
),
latest AS (
  SELECT rps_numero, rps_serie, rps_tipo,
    arg_max(status, tentativa) AS status_final,
    arg_max(numero_nfse_gerado, tentativa) AS numero_nfse_gerado,
    arg_max(data_envio, tentativa) AS ultimo_envio,
    COUNT(*) AS tentativas, COUNT(*) FILTER (WHERE status = 'ERRO') AS erros,
    CAST(SUM(tempo) AS DOUBLE) AS tempo_total_segundos
  FROM rps2 GROUP BY rps_numero, rps_serie, rps_tipo
)"""

RPS_LATEST = "WITH " + RPS + " SELECT * FROM latest"
RPS_OUTCOMES = "WITH " + INV + "," + RPS + """
SELECT status_final, COUNT(*) AS rps,
  COUNT(*) FILTER (WHERE numero_nfse_gerado IN (SELECT numero_nfse FROM inv)) AS convertidos,
  CAST(SUM(tentativas) AS BIGINT) AS tentativas
FROM latest GROUP BY status_final ORDER BY status_final"""


def _req(table: str, src: str, cols) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS tabela, 'obrigatorio' AS regra, '{c}' AS coluna, COUNT(*) FILTER (WHERE {c} IS NULL) AS violacoes FROM {src}"
        for c in cols)


def _dom(table: str, src: str, col: str, allowed) -> str:
    vals = ", ".join(f"'{v}'" for v in allowed)
    return (f"SELECT '{table}', 'dominio', '{col}', COUNT(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})) FROM {src}")


CONTRACT_CHECKS = "WITH " + INV + "," + RPS + f""",
nf AS (
  SELECT 'x' AS id, numero_nfse,
    CASE WHEN l_orderkey % 50 <> 0 THEN codigo_verificacao END AS codigo_verificacao,
    data_emissao,
    CASE WHEN l_orderkey % 61 = 0 THEN 'Substituida' WHEN l_orderkey % 11 = 0 THEN 'Cancelado' ELSE 'Normal' END AS status_nfse,
    'c' AS prestador_cnpj, 'n' AS prestador_razao_social, valor_servicos,
    CASE WHEN l_orderkey % 70 <> 0 THEN valor_liquido END AS valor_liquido_nfse,
    1 AS data_processamento, 1 AS data_criacao
  FROM inv
),
tx AS (
  SELECT 'x' AS id, numero_nfse, tipo_tributo, valor, 1 AS data_criacao FROM (
    SELECT numero_nfse, 'PIS' AS tipo_tributo, valor_pis AS valor FROM inv
    UNION ALL SELECT numero_nfse, 'COFINS', valor_cofins FROM inv
    UNION ALL SELECT numero_nfse, 'INSS', valor_inss FROM inv
    UNION ALL SELECT numero_nfse, 'IR', valor_ir FROM inv
    UNION ALL SELECT numero_nfse, 'CSLL', valor_csll FROM inv
    UNION ALL SELECT numero_nfse, 'ISS', valor_iss FROM inv) WHERE valor IS NOT NULL
),
rl AS (SELECT 'x' AS id, rps_numero, rps_serie, rps_tipo, data_envio, status, tentativa, data_envio AS data_criacao FROM rps2)
{_req('nf_emitidas', 'nf', ('id', 'numero_nfse', 'codigo_verificacao', 'data_emissao', 'status_nfse', 'prestador_cnpj',
                            'prestador_razao_social', 'valor_servicos', 'valor_liquido_nfse', 'data_processamento',
                            'data_criacao'))}
UNION ALL {_dom('nf_emitidas', 'nf', 'status_nfse', ('Normal', 'Cancelado'))}
UNION ALL {_req('nf_tributos', 'tx', ('id', 'numero_nfse', 'tipo_tributo', 'valor', 'data_criacao'))}
UNION ALL {_dom('nf_tributos', 'tx', 'tipo_tributo', ('PIS', 'COFINS', 'INSS', 'IR', 'CSLL', 'ISS', 'OUTROS'))}
UNION ALL {_req('rps_log', 'rl', ('id', 'rps_numero', 'rps_serie', 'rps_tipo', 'data_envio', 'status', 'tentativa', 'data_criacao'))}
UNION ALL {_dom('rps_log', 'rl', 'status', ('ENVIADO', 'PROCESSANDO', 'SUCESSO', 'ERRO', 'CANCELADO'))}
UNION ALL {_dom('rps_log', 'rl', 'rps_tipo', ('1', '2', '3'))}"""

ORACLES.update({
    "client_score": CLIENT_SCORE,
    "top_opportunities": TOP_OPPORTUNITIES,
    "validation_progress": VALIDATION_PROGRESS,
    "cnpj_valid": CNPJ_VALID,
    "cpf_valid": CPF_VALID,
    "pending_validation": PENDING_VALIDATION,
    "validation_days": VALIDATION_DAYS,
    "contract_checks": CONTRACT_CHECKS,
    "unpivot_taxes": UNPIVOT_TAXES,
    "orphan_taxes": ORPHAN_TAXES,
    "rps_latest": RPS_LATEST,
    "rps_outcomes": RPS_OUTCOMES,
})


# ------------------------------------------------------------- streaming
STREAM_DEDUP = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
STREAM_STATUS = """SELECT event_type, COUNT(*) AS total_linhas,
  CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS valor_total FROM events GROUP BY event_type"""

STREAM_KPIS = """SELECT time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '1970-01-01 00:00:00') AS inicio,
  time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '1970-01-01 00:00:00') + INTERVAL '3 hours' AS fim,
  COUNT(*) AS eventos, COUNT(DISTINCT user_id) AS usuarios,
  CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS valor_total
FROM events GROUP BY 1, 2"""

ORACLES.update({
    "stream_resent": "SELECT DISTINCT * EXCLUDE (ts) FROM events",
    "stream_dedup": STREAM_DEDUP,
    "stream_dedup_state": STREAM_DEDUP,
    "stream_status": STREAM_STATUS,
    "stream_kpis": STREAM_KPIS,
    "stream_kpis_merged": f"SELECT inicio, fim, eventos, true AS usuarios_proximos, valor_total FROM ({STREAM_KPIS})",
})


# ------------------------------------------------------------- spreadsheet path
def _arr(vals) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in vals) + "]"


def _cells_sql() -> str:
    from ..sources.adapter import SHEET_HEADERS, WORKBOOK_NAMES
    return f"""
pp AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, p_retailprice,
    CAST(split_part(p_brand, '#', 2) AS INTEGER) - 1 AS idx
  FROM part
),
pf AS (
  SELECT *, {_arr(WORKBOOK_NAMES)}[idx % 5 + 1] || ' ' || split_part(p_brand, '#', 2) || '.xlsx' AS arquivo_nome,
    'Aba' || CAST(p_size % 3 + 1 AS VARCHAR) AS aba_nome,
    CAST(DATE '2005-01-01' + CAST(k % 2500 AS INTEGER) AS DATE) AS d,
    printf('%.2f', p_retailprice) AS price,
    lpad(CAST(k AS VARCHAR), 14, '0') AS dg
  FROM pp
),
dc AS (
  SELECT arquivo_nome, aba_nome, k + 1 AS linha, k % 17 = 0 AS vazio, unnest([
    struct_pack(coluna := 0, valor := CASE WHEN k % 23 <> 0 THEN CAST(k AS VARCHAR) END),
    struct_pack(coluna := 1, valor := p_name),
    struct_pack(coluna := 2, valor := substr(dg, 1, 2) || '.' || substr(dg, 3, 3) || '.' || substr(dg, 6, 3) || '/' || substr(dg, 9, 4) || '-' || substr(dg, 13, 2)),
    struct_pack(coluna := 3, valor := CASE k % 4 WHEN 0 THEN strftime(d, '%Y-%m-%d')
        WHEN 1 THEN CAST(day(d) AS VARCHAR) || '/' || CAST(month(d) AS VARCHAR) || '/' || CAST(year(d) AS VARCHAR)
        WHEN 2 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00' ELSE 'sem data' END),
    struct_pack(coluna := 4, valor := CASE k % 3 WHEN 0 THEN price WHEN 1 THEN replace(price, '.', ',')
        ELSE '1.' || replace(price, '.', ',') END),
    struct_pack(coluna := 5, valor := CASE k % 5 WHEN 0 THEN CAST(p_size AS VARCHAR) || '/' || CAST(k % 7 AS VARCHAR)
        WHEN 1 THEN CAST(p_size AS VARCHAR) || '/2' WHEN 2 THEN '10/2023' WHEN 3 THEN '1/2/3' ELSE 'a/b' END),
    struct_pack(coluna := 6, valor := CAST(NULL AS VARCHAR)),
    struct_pack(coluna := 7, valor := ['nan', 'None', '.', ' x ', 'x None', p_type][k % 6 + 1])
  ]) AS c FROM pf
),
sheets AS (SELECT DISTINCT arquivo_nome, aba_nome, p_size % 3 AS s FROM pf),
hc AS (
  SELECT arquivo_nome, aba_nome, 0 AS linha, CAST(i AS INTEGER) AS coluna,
    CASE s WHEN 0 THEN {_arr(SHEET_HEADERS[0])}[i + 1] WHEN 1 THEN {_arr(SHEET_HEADERS[1])}[i + 1]
           ELSE {_arr(SHEET_HEADERS[2])}[i + 1] END AS valor
  FROM sheets, (SELECT unnest(range(8)) AS i)
),
cells AS (
  SELECT arquivo_nome, aba_nome, linha, c.coluna AS coluna, CASE WHEN NOT vazio THEN c.valor END AS valor FROM dc
  UNION ALL SELECT arquivo_nome, aba_nome, linha, coluna, valor FROM hc
),
hdr AS (
  SELECT arquivo_nome, aba_nome, coluna, valor AS cabecalho, {_norm_sql("valor", "coluna")} AS nome
  FROM cells WHERE linha = 0
),
nonempty AS (SELECT DISTINCT arquivo_nome, aba_nome, coluna FROM cells WHERE linha > 0 AND valor IS NOT NULL),
settled0 AS (SELECT h.* FROM hdr h SEMI JOIN nonempty n USING (arquivo_nome, aba_nome, coluna)),
settled AS (
  SELECT arquivo_nome, aba_nome, coluna, cabecalho,
    CASE WHEN rn > 1 THEN nome || '_' || CAST(rn - 1 AS VARCHAR) ELSE nome END AS nome
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY arquivo_nome, aba_nome, nome ORDER BY coluna) AS rn FROM settled0)
),
keeprows AS (SELECT DISTINCT arquivo_nome, aba_nome, linha FROM cells WHERE linha > 0 AND valor IS NOT NULL),
clean AS (
  SELECT c.arquivo_nome, c.aba_nome, c.linha, c.coluna, s.nome AS coluna_nome, {_clean_sql("c.valor")} AS valor
  FROM cells c
  JOIN keeprows r ON c.arquivo_nome = r.arquivo_nome AND c.aba_nome = r.aba_nome AND c.linha = r.linha
  JOIN settled s ON c.arquivo_nome = s.arquivo_nome AND c.aba_nome = s.aba_nome AND c.coluna = s.coluna
  WHERE c.linha > 0
)"""


def _norm_sql(v: str, idx: str) -> str:
    h = f"trim(COALESCE({v}, ''), ' ' || chr(9) || chr(10) || chr(13))"
    h = f"replace(replace(replace({h}, chr(10), ' '), chr(13), ''), '  ', ' ')"
    h = f"strip_accents({h})"
    # FIXED VALUES — header replacements, in the order they apply.
    for old, new in ((".", "_"), ("º", "_num"), ("ª", "_a"), (" ", "_"), ("/", "_"), ("-", "_"),
                     ("(", ""), (")", ""), ("&", "_e_"), ("%", "_pct"), ("#", "_num"), ("°", "_grau")):
        h = f"replace({h}, '{old}', '{new}')"
    h = f"(CASE WHEN regexp_matches({h}, '^[0-9]') THEN 'col_' || {h} ELSE {h} END)"
    h = f"regexp_replace(regexp_replace({h}, '_{{2,}}', '_', 'g'), '_+$', '')"
    return f"(CASE WHEN {h} = '' OR lower({h}) LIKE '%unnamed%' THEN 'coluna_' || CAST({idx} AS VARCHAR) ELSE {h} END)"


def _clean_sql(v: str) -> str:
    v0 = f"trim(COALESCE({v}, ''), ' ' || chr(9) || chr(10) || chr(13))"
    v1 = f"(CASE WHEN {v0} IN ('nan', 'None', 'NaT', '.', '') THEN '' ELSE {v0} END)"
    q = (f"regexp_replace(CAST(CAST(round_even(CAST(split_part({v1}, '/', 1) AS DOUBLE) / "
         f"CAST(split_part({v1}, '/', 2) AS DOUBLE), 6) AS DECIMAL(38,6)) AS VARCHAR), '0+$', '')")
    q = f"(CASE WHEN {q} LIKE '%.' THEN {q} || '0' ELSE {q} END)"
    return (f"(CASE WHEN regexp_full_match({v1}, '[0-9]+/[0-9]+') AND CAST(split_part({v1}, '/', 2) AS DOUBLE) <> 0 "
            f"THEN {q} ELSE {v1} END)")


def _date_sql(v: str) -> str:
    return (f"CAST(COALESCE(try_strptime({v}, '%Y-%m-%d'), try_strptime({v}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({v}, '%d/%m/%Y')) AS DATE)")


def _float_sql(v: str) -> str:
    t = f"replace(trim({v}), ',', '.')"
    return f"(CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({t} AS DOUBLE) END)"


def _class_sql(n: str) -> str:
    return (f"(CASE WHEN lower({n}) LIKE '%faturamento%' AND regexp_matches({n}, '2006|2007|2008|2009|2010') "
            f"THEN 'faturamento_historico' WHEN lower({n}) LIKE '%empresas antigas%' THEN 'empresas_antigas' "
            f"WHEN lower({n}) LIKE '%todos clientes%' THEN 'clientes_atuais' ELSE 'desconhecido' END)")


def _route_sql(t: str) -> str:
    return (f"(CASE {t} WHEN 'faturamento_historico' THEN 'faturamento_historico' WHEN 'empresas_antigas' "
            f"THEN 'empresas_antigas' WHEN 'clientes_atuais' THEN 'clientes_atuais' ELSE 'dados_genericos' END)")


CELLS = _cells_sql()

FILE_CLASSIFY = "WITH " + CELLS + f"""
SELECT arquivo_nome, {_class_sql('arquivo_nome')} AS tipo_arquivo, {_route_sql(_class_sql('arquivo_nome'))} AS tabela_destino
FROM (SELECT DISTINCT arquivo_nome FROM cells)"""
HEADER_NORMALIZE = "WITH " + CELLS + " SELECT arquivo_nome, aba_nome, coluna, cabecalho, nome FROM hdr"
HEADER_DEDUP = "WITH " + CELLS + " SELECT arquivo_nome, aba_nome, coluna, nome FROM settled"
CLEAN_CELLS = "WITH " + CELLS + " SELECT * FROM clean"

_TXT = "substr(trim(NULLIF(NULLIF({x}, ''), 'nan')), 1, 1000)"
COERCE_TYPES = "WITH " + CELLS + f""",
w AS (
  SELECT arquivo_nome, aba_nome, linha,
    MAX(CASE WHEN coluna_nome = 'Nota_Fiscal_n_num' THEN valor END) AS a,
    MAX(CASE WHEN coluna_nome = 'Razao_Social' THEN valor END) AS b,
    MAX(CASE WHEN coluna_nome = 'CNPJ' THEN valor END) AS c,
    MAX(CASE WHEN coluna_nome = 'Data_Emissao' THEN valor END) AS d,
    MAX(CASE WHEN coluna_nome = 'Valor_Liquido_R$' THEN valor END) AS e,
    MAX(CASE WHEN coluna_nome = 'Honorarios_pct' THEN valor END) AS f
  FROM clean GROUP BY 1, 2, 3
)
SELECT arquivo_nome, aba_nome, linha,
  {_TXT.format(x='a')} AS numero_nota, {_TXT.format(x='b')} AS razao_social, {_TXT.format(x='c')} AS cnpj,
  {_date_sql("trim(NULLIF(NULLIF(d, ''), 'nan'))")} AS data_emissao,
  {_float_sql("NULLIF(NULLIF(e, ''), 'nan')")} AS valor_liquido,
  {_float_sql("NULLIF(NULLIF(f, ''), 'nan')")} AS honorarios,
  CAST(NULL AS VARCHAR) AS observacao
FROM w"""

DROP_EMPTY = "WITH " + CELLS + """,
rr AS (SELECT arquivo_nome, aba_nome, linha, COUNT(valor) AS n FROM cells WHERE linha > 0 GROUP BY 1, 2, 3),
r AS (SELECT arquivo_nome, aba_nome, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE n = 0) AS linhas_vazias FROM rr GROUP BY 1, 2),
cc AS (SELECT h.arquivo_nome, h.aba_nome, h.coluna, COUNT(c.valor) AS n FROM hdr h
       LEFT JOIN cells c ON c.linha > 0 AND c.arquivo_nome = h.arquivo_nome AND c.aba_nome = h.aba_nome AND c.coluna = h.coluna
       GROUP BY 1, 2, 3),
c AS (SELECT arquivo_nome, aba_nome, COUNT(*) AS colunas, COUNT(*) FILTER (WHERE n = 0) AS colunas_vazias FROM cc GROUP BY 1, 2)
SELECT COALESCE(r.arquivo_nome, c.arquivo_nome) AS arquivo_nome, COALESCE(r.aba_nome, c.aba_nome) AS aba_nome,
  r.linhas, r.linhas_vazias, c.colunas, c.colunas_vazias
FROM r FULL OUTER JOIN c ON r.arquivo_nome = c.arquivo_nome AND r.aba_nome = c.aba_nome"""

SHEET_DOCUMENTS = "WITH " + CELLS + f""",
docs AS (
  SELECT arquivo_nome, aba_nome, linha,
    CAST(to_json(map_from_entries(list(struct_pack(k := coluna_nome, v := valor) ORDER BY coluna_nome))) AS VARCHAR) AS dados_json
  FROM clean GROUP BY 1, 2, 3
)
SELECT arquivo_nome, {_class_sql('arquivo_nome')} AS arquivo_tipo, aba_nome, dados_json, linha AS linha_original,
  sha256(dados_json) AS hash_linha, 'processed' AS _processing_status,
  {_route_sql(_class_sql('arquivo_nome'))} AS tabela_destino
FROM docs"""

FILE_PROFILE = "WITH " + CELLS + f""",
fr AS (SELECT arquivo_nome, COUNT(*) AS total_linhas FROM keeprows GROUP BY 1),
fc AS (SELECT arquivo_nome, list_sort(list(DISTINCT nome)) AS colunas_detectadas, COUNT(DISTINCT aba_nome) AS total_abas,
              list_sort(list(DISTINCT aba_nome)) AS abas_nomes FROM settled GROUP BY 1),
fd AS (SELECT arquivo_nome, MIN({_date_sql('valor')}) AS periodo_inicio, MAX({_date_sql('valor')}) AS periodo_fim
       FROM clean WHERE coluna_nome = 'Data_Emissao' GROUP BY 1)
SELECT fc.arquivo_nome, total_abas, abas_nomes, COALESCE(total_linhas, 0) AS total_linhas, colunas_detectadas,
  {_class_sql('fc.arquivo_nome')} AS tipo_arquivo, periodo_inicio, periodo_fim,
  CASE WHEN COALESCE(total_linhas, 0) > 0 THEN 'processado' ELSE 'vazio' END AS status
FROM fc LEFT JOIN fr USING (arquivo_nome) LEFT JOIN fd USING (arquivo_nome)"""


def _column_match_sql() -> str:
    from .registry import HISTORIC_TARGET
    vals = ", ".join(f"('faturamento_historico', '{n}', '{t}')" for n, t in HISTORIC_TARGET)
    return "WITH " + CELLS + f""",
src AS (
  SELECT nome, MIN(struct_pack(a := arquivo_nome, b := aba_nome, c := coluna)) AS ordem FROM settled
  WHERE {_class_sql('arquivo_nome')} = 'faturamento_historico' GROUP BY nome
),
tgt AS (SELECT * FROM (VALUES {vals}) t(tabela, coluna_destino, tipo)),
m AS (
  SELECT t.tabela, t.coluna_destino, t.tipo, s.ordem, s.nome FROM tgt t JOIN src s ON lower(s.nome) = lower(t.coluna_destino)
  UNION ALL
  SELECT t.tabela, t.coluna_destino, t.tipo, s.ordem, s.nome FROM tgt t JOIN src s
    ON replace(replace(replace(lower(s.nome), '_', ' '), 'º', ''), 'ª', '') = replace(lower(t.coluna_destino), '_', ' ')
),
best AS (SELECT tabela, coluna_destino, tipo, arg_min(nome, ordem) AS coluna_origem FROM m GROUP BY 1, 2, 3)
SELECT t.tabela, t.coluna_destino, t.tipo, b.coluna_origem FROM tgt t LEFT JOIN best b USING (tabela, coluna_destino, tipo)"""


ORACLES.update({
    "file_classify": FILE_CLASSIFY,
    "header_normalize": HEADER_NORMALIZE,
    "header_dedup": HEADER_DEDUP,
    "clean_cells": CLEAN_CELLS,
    "coerce_types": COERCE_TYPES,
    "drop_empty": DROP_EMPTY,
    "sheet_documents": SHEET_DOCUMENTS,
    "file_profile": FILE_PROFILE,
})
ORACLES["column_match"] = _column_match_sql()

ORACLES["workbook_cells"] = "WITH " + CELLS + " SELECT arquivo_nome, aba_nome, linha, coluna, valor FROM cells WHERE valor IS NOT NULL"

CONTRACT_QUARANTINE = CONTRACT_CHECKS[:CONTRACT_CHECKS.index("tx AS (")].rstrip().rstrip(",") + """
SELECT * FROM (SELECT numero_nfse, concat_ws(',',
    CASE WHEN codigo_verificacao IS NULL THEN 'obrigatorio:codigo_verificacao' END,
    CASE WHEN valor_liquido_nfse IS NULL THEN 'obrigatorio:valor_liquido_nfse' END,
    CASE WHEN status_nfse NOT IN ('Normal', 'Cancelado') THEN 'dominio:status_nfse' END) AS violacoes
  FROM nf) WHERE violacoes <> ''"""
ORACLES["contract_quarantine"] = CONTRACT_QUARANTINE

ORACLES["landed_staging"] = "WITH " + CELLS + f""",
g AS (
  SELECT arquivo_nome, aba_nome, linha,
    max(CASE WHEN coluna_nome = 'CNPJ' THEN valor END) AS cnpj_, max(CASE WHEN coluna_nome = 'Data_Emissao' THEN valor END) AS d_,
    max(CASE WHEN coluna_nome = 'Valor_Liquido_R$' THEN valor END) AS v_,
    max(CASE WHEN coluna_nome = 'Cliente' THEN valor END) AS c_, max(CASE WHEN coluna_nome = 'Razao_Social' THEN valor END) AS r_
  FROM clean GROUP BY 1, 2, 3
),
s AS (
  SELECT arquivo_nome, aba_nome, linha AS linha_original, COALESCE(c_, r_) AS cliente, {_date_sql("d_")} AS data_emissao,
    regexp_replace(cnpj_, '[^0-9]', '', 'g') AS cnpj, CAST(NULL AS VARCHAR) AS numero_nota,
    {_float_sql("v_")} AS valor_liquido, CAST(NULL AS DOUBLE) AS valor_bruto, CAST(NULL AS DOUBLE) AS honorarios,
    CAST(NULL AS VARCHAR) AS tipo_servico, CAST(NULL AS VARCHAR) AS situacao, CAST(NULL AS VARCHAR) AS consultor
  FROM g WHERE {_class_sql("arquivo_nome")} IN ('faturamento_historico', 'clientes_atuais', 'desconhecido')
)
SELECT * FROM s WHERE cnpj IS NOT NULL AND data_emissao IS NOT NULL AND valor_liquido IS NOT NULL"""

_DROPS = "WITH " + CELLS + f""",
fmt AS (
  SELECT DISTINCT arquivo_nome, aba_nome,
    ['csv', 'jsonl', 'xlsx'][(CAST(regexp_extract(arquivo_nome, '([0-9]+)\\.xlsx$', 1) AS INTEGER) + CAST(substr(aba_nome, 4, 1) AS INTEGER)) % 3 + 1] AS f
  FROM cells
),
lines AS (
  SELECT arquivo_nome, aba_nome, linha, ROW_NUMBER() OVER (PARTITION BY arquivo_nome, aba_nome ORDER BY linha) AS n
  FROM (SELECT DISTINCT arquivo_nome, aba_nome, linha FROM cells WHERE linha > 0)
)"""

ORACLES["landed_drops"] = _DROPS + f""",
docs AS (
  SELECT arquivo_nome, aba_nome, linha, max(CASE WHEN coluna_nome = 'CNPJ' THEN valor END) AS cnpj_,
    CAST(to_json(map_from_entries(list(struct_pack(k := coluna_nome, v := valor) ORDER BY coluna_nome))) AS VARCHAR) AS dados_json
  FROM clean GROUP BY 1, 2, 3
)
SELECT CASE f WHEN 'xlsx' THEN d.arquivo_nome ELSE replace(d.arquivo_nome, '.xlsx', ' ' || d.aba_nome || '.' || f) END AS arquivo_nome,
  {_class_sql('d.arquivo_nome')} AS arquivo_tipo, dados_json, CASE f WHEN 'xlsx' THEN d.linha ELSE n END AS linha_original,
  sha256(dados_json) AS hash_linha, nullif(regexp_replace(cnpj_, '[^0-9]', '', 'g'), '') AS cnpj, 'processed' AS _processing_status
FROM docs d JOIN fmt USING (arquivo_nome, aba_nome) JOIN lines USING (arquivo_nome, aba_nome, linha)"""

ORACLES["drops_quarantine"] = _DROPS + """
SELECT replace(arquivo_nome, '.xlsx', ' ' || aba_nome || '.' || f) AS arquivo_nome, MAX(n) + 1 AS linha, '"aberta' AS texto,
  CASE f WHEN 'csv' THEN 'aspas sem par' ELSE 'linha sem objeto JSON' END AS erro
FROM fmt JOIN lines USING (arquivo_nome, aba_nome) WHERE f <> 'xlsx' GROUP BY arquivo_nome, aba_nome, f"""

_LEDGER = "WITH " + CELLS + f""",
f AS (
  SELECT arquivo_nome, COUNT(DISTINCT aba_nome) AS total_abas,
    COUNT(DISTINCT CASE WHEN linha > 0 AND valor IS NOT NULL THEN aba_nome || '#' || CAST(linha AS VARCHAR) END) AS total_linhas
  FROM cells GROUP BY 1
),
ledger AS (
  SELECT arquivo_nome, total_abas, total_linhas, {_class_sql("arquivo_nome")} AS tipo_arquivo, 'processado' AS status,
    true AS tem_hash, true AS tem_bytes, false AS tem_erro FROM f
  UNION ALL
  SELECT 'corrompido ' || arquivo_nome, 0, 0, 'erro', 'erro', true, true, true FROM f
  WHERE CAST(regexp_extract(arquivo_nome, '([0-9]+)\\.xlsx$', 1) AS INTEGER) % 5 = 0
)"""
ORACLES["routed_documents"] = "WITH " + CELLS + f""",
t AS (SELECT DISTINCT arquivo_nome, aba_nome, linha, {_class_sql("arquivo_nome")} AS tipo FROM clean)
SELECT CASE tipo WHEN 'faturamento_historico' THEN 'faturamento_historico' WHEN 'empresas_antigas' THEN 'empresas_antigas'
            WHEN 'clientes_atuais' THEN 'clientes_atuais' ELSE 'dados_genericos' END AS tabela_destino,
  arquivo_nome, COUNT(*) AS linhas
FROM t GROUP BY 1, 2"""
ORACLES["file_ledger"] = _LEDGER + " SELECT * FROM ledger"
ORACLES["run_report"] = _LEDGER + " SELECT status, COUNT(*) AS arquivos FROM ledger GROUP BY status"

ORACLES["load_report"] = "WITH " + BASE + """,
batch AS (
  SELECT sha256(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
                || lpad(CAST((l_orderkey * 31 + l_linenumber * 7) % 1000000000 AS VARCHAR), 9, '0')
                || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')) AS h, CAST(l_shipdate AS DATE) AS d
  FROM cents2
),
ins AS (SELECT COUNT(DISTINCT h) AS n FROM batch WHERE h NOT IN (SELECT h FROM batch WHERE d < DATE '1999-01-01'))
SELECT COUNT(*) AS linhas_lote, COUNT(DISTINCT h) AS chaves_distintas, (SELECT n FROM ins) AS inseridas,
  COUNT(*) - (SELECT n FROM ins) AS ignoradas,
  round((SELECT n FROM ins) * 100.0 / COUNT(*), 1) AS taxa_sucesso_pct
FROM batch"""

ORACLES["stream_invoice_load"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY hash_nfse ORDER BY numero_nfse, codigo_verificacao, data_emissao,
    data_competencia, prestador_cnpj, prestador_razao_social, tomador_cnpj NULLS FIRST, tomador_cpf NULLS FIRST,
    tomador_razao_social, tomador_endereco, tomador_municipio NULLS FIRST, tomador_uf, tomador_cep, valor_servicos,
    valor_deducoes, valor_pis, valor_cofins, valor_inss, valor_ir, valor_csll, valor_iss, valor_liquido,
    discriminacao, item_lista_servico, data_processamento, origem_consulta) AS rn
  FROM (""" + XML_INVOICES + """)) WHERE rn = 1"""

# ------------------------------------------------------------- layouts
ORACLES["staging_variant"] = STAGING_BILLING
ORACLES["companies_variant"] = STAGING_COMPANIES
ORACLES["clustered_invoices"] = "WITH " + INV + """
SELECT numero_nfse, tomador_cnpj, data_emissao, CAST(valor_liquido AS DOUBLE) AS valor_liquido FROM inv"""
ORACLES["customer_months"] = "WITH " + DIM + """
SELECT d.cliente_key, d.cnpj, d.status_cliente, d.segmento_valor, year(b.data_emissao) AS ano, month(b.data_emissao) AS mes,
  COUNT(*) AS total_notas, CAST(SUM(CAST(b.valor_liquido AS DECIMAL(38,9))) AS DOUBLE) AS faturamento_total
FROM stg_billing b JOIN dim d ON b.cnpj = d.cnpj WHERE b.cnpj <> '' GROUP BY ALL"""

# ------------------------------------------------------------- typed load, daily report
_TEXT = "NULLIF(NULLIF({x}, ''), 'nan')"
_DAY = _date_sql("trim(NULLIF(NULLIF(d, ''), 'nan'))")
_TYPED = COERCE_TYPES.replace("SELECT arquivo_nome, aba_nome, linha,\n  " + _TXT.format(x="a"), """, x AS (
SELECT w.arquivo_nome, aba_nome, linha, d, e, f,
  """ + _TXT.format(x="a")).replace("CAST(NULL AS VARCHAR) AS observacao", """CAST(NULL AS VARCHAR) AS observacao,
  """ + _DAY.removeprefix("CAST(").removesuffix(" AS DATE)") + " AS emitido_em") + f"""),
y AS (SELECT *,
  2 * CASE WHEN {_TEXT.format(x='d')} IS NOT NULL AND data_emissao IS NULL THEN 1 ELSE 0 END
  + CASE WHEN {_TEXT.format(x='e')} IS NOT NULL AND valor_liquido IS NULL THEN 1 ELSE 0 END
  + CASE WHEN {_TEXT.format(x='f')} IS NOT NULL AND honorarios IS NULL THEN 1 ELSE 0 END AS valores_invalidos FROM x)
"""
ORACLES["typed_load"] = _TYPED + f"""SELECT * EXCLUDE (d, e, f, valores_invalidos), 'cliente padrao' AS cliente_nome,
  {AS_OF} AS data_processamento, 'google_drive' AS origem_arquivo, {_class_sql('arquivo_nome')} AS tipo_arquivo
FROM y WHERE valores_invalidos = 0"""
ORACLES["typed_quarantine"] = _TYPED + "SELECT arquivo_nome, aba_nome, linha, valores_invalidos FROM y WHERE valores_invalidos > 0"
ORACLES["typed_report"] = _TYPED + """SELECT arquivo_nome, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE valores_invalidos = 0) AS inseridas,
  COUNT(*) FILTER (WHERE valores_invalidos > 0) AS erros, CAST(SUM(valores_invalidos) AS BIGINT) AS valores_invalidos,
  floor(CAST(COUNT(*) FILTER (WHERE valores_invalidos = 0) AS DOUBLE) * 100 / COUNT(*) * 10 + 0.5) / 10 AS taxa_sucesso_pct
FROM y GROUP BY arquivo_nome"""
ORACLES["report_kpis"] = EXECUTIVE_KPIS
ORACLES["report_opportunities"] = TOP_OPPORTUNITIES
