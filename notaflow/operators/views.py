"""The five analytics views over the 27-column invoice table (CPF, GEO, KPI, OPP, REC).

Aggregation runs on exact decimals (partial + final aggregation, map-side
combine); results become doubles at the output boundary. Distinct counts over
bounded domains (month of year, year, year-month, service items of one
customer) are bit sets or second-level counts, so no multi-distinct Expand multiplies
the notes. A customer's service items are bounded by the service list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RULES, Rules
from ..functions.exprs import (as_of_lit, band, days_between, lookup, mean_of, months_before,
                               round_half_away)
from .rank import global_row_number

FEDERAL = ("valor_pis", "valor_cofins", "valor_inss", "valor_ir", "valor_csll")


def _federal_sum():
    """SUM(a+b+c+d+e): a NULL tax drops the whole row from the sum."""
    e = F.col(FEDERAL[0])
    for c in FEDERAL[1:]:
        e = e + F.col(c)
    return F.sum(e)


# ------------------------------------------------------------------ CPF-1..7
def customer_performance(inv: DataFrame, as_of: str, rules: Rules = RULES) -> DataFrame:
    asof = as_of_lit(as_of)
    keys = ["tomador_cnpj", "tomador_razao_social", "tomador_uf", "tomador_municipio"]
    parts = [F.count(F.lit(1)).alias("_rows"), F.sum("valor_liquido").alias("_fat"), F.count("valor_liquido").alias("_n"),
             F.max("data_emissao").alias("_last"), F.min("data_emissao").alias("_first"),
             F.bit_or(F.expr("shiftleft(1, month(data_emissao))")).alias("_months")]
    g = (inv.filter(F.col("tomador_cnpj").isNotNull())
         .groupBy(*keys, F.year("data_emissao").alias("_ano"))
         .agg(*parts))
    # Months as a bit set, years as the rows of the first level: plain hash aggregates.
    g = (g.groupBy(*keys).agg(
        F.sum("_rows").alias("total_nfses"), F.sum("_fat").alias("_fat"), F.sum("_n").alias("_n"),
        F.max("_last").alias("ultima_nfse"), F.min("_first").alias("primeira_nfse"),
        F.coalesce(F.bit_count(F.bit_or("_months")), F.lit(0)).cast("bigint").alias("meses_ativos"),
        F.count("_ano").alias("anos_ativos")))
    m = g.select(
        "tomador_cnpj", "tomador_razao_social", "tomador_uf", "tomador_municipio", "total_nfses",
        F.col("_fat").cast("double").alias("faturamento_total"),
        mean_of(F.col("_fat"), F.col("_n")).alias("ticket_medio"),
        "ultima_nfse", "primeira_nfse",
        days_between(asof, F.col("ultima_nfse")).alias("dias_sem_servico"),
        days_between(F.col("ultima_nfse"), F.col("primeira_nfse")).alias("relacionamento_dias"),
        "meses_ativos", "anos_ativos")
    days, fat, tk, months = (F.col("dias_sem_servico"), F.col("faturamento_total"),
                             F.col("ticket_medio"), F.col("meses_ativos"))
    cs = None
    for mo, tick, label in rules.crosssell_potential:
        cond = (months >= mo) & (tk >= tick)
        cs = F.when(cond, label) if cs is None else cs.when(cond, label)
    m = m.select(
        "*",
        band(days, rules.reactivation_days, rules.reactivation_default).alias("score_reativacao"),
        band(fat, rules.value_class, rules.value_class_default, ">=").alias("categoria_valor"),
        band(days, rules.activity_days, rules.activity_default).alias("status_cliente"),
        cs.otherwise(rules.crosssell_potential_default).alias("potencial_crosssell"))
    w_r, w_v = rules.opportunity_weights
    weight = lookup(F.col("categoria_valor"), rules.value_class_weight,
                    rules.value_class_weight_default)
    score = (F.col("score_reativacao") * F.lit(w_r).cast("decimal(3,2)")
             + weight * F.lit(w_v).cast("decimal(3,2)")).cast("double")
    return m.select(
        "*",
        (F.try_divide(fat, F.col("relacionamento_dias")) * 365 * rules.ltv_years).alias("ltv_estimado"),
        score.alias("score_oportunidade"))


# ------------------------------------------------------------------ GEO-1..6
def geo_expansion(inv: DataFrame, as_of: str, rules: Rules = RULES) -> DataFrame:
    """Two-level aggregation instead of three distinct counts: first per
    (uf, city, cnpj) — partial aggregation absorbs a hot customer — then per place."""
    asof = as_of_lit(as_of)
    recent = F.col("data_emissao") >= months_before(asof, rules.recent_months)
    per_cust = (inv.filter(F.col("tomador_uf").isNotNull())
                .groupBy("tomador_uf", "tomador_municipio", "tomador_cnpj")
                .agg(F.count(F.lit(1)).alias("_rows"),
                     F.sum("valor_liquido").alias("_sum"),
                     F.count("valor_liquido").alias("_cnt"),
                     F.sum(F.when(recent, F.col("valor_liquido")).otherwise(F.lit(0))).alias("_sum12"),
                     F.max(recent).alias("_recent")))
    cnpj = F.col("tomador_cnpj")
    g = (per_cust.groupBy("tomador_uf", "tomador_municipio")
         .agg(F.count(cnpj).alias("total_clientes"),
              F.sum("_rows").alias("total_nfses"),
              F.sum("_sum").alias("_fat"),
              F.sum("_cnt").alias("_n"),
              F.count(F.when(F.col("_recent"), cnpj)).alias("clientes_ultimos_12m"),
              F.sum("_sum12").alias("_fat12")))
    # COUNT(DISTINCT city) inside a (uf, city) group is 1, or 0 for the NULL city.
    cities = F.when(F.col("tomador_municipio").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    g = g.select(
        "tomador_uf", "tomador_municipio", "total_clientes", "total_nfses",
        F.col("_fat").cast("double").alias("faturamento_total"),
        mean_of(F.col("_fat"), F.col("_n")).alias("ticket_medio_local"),
        "clientes_ultimos_12m",
        F.col("_fat12").cast("double").alias("faturamento_12m"),
        F.try_divide(F.col("total_clientes").cast("double"),
                     F.when(cities != 0, cities)).alias("densidade_clientes_municipio"))
    fat, ncli = F.col("faturamento_total"), F.col("total_clientes")
    mk = None
    for amount, clients, label in rules.market_class:
        cond = (fat >= amount) & (ncli >= clients) if amount else (ncli >= clients)
        mk = F.when(cond, label) if mk is None else mk.when(cond, label)
    g = g.select("*", mk.otherwise(rules.market_default).alias("classificacao_mercado"),
                 (F.try_divide(F.col("faturamento_12m"),
                               F.when(F.col("clientes_ultimos_12m") != 0,
                                      F.col("clientes_ultimos_12m")))
                  * rules.roi_factor).alias("roi_estimado_expansao"))
    weight = lookup(F.col("classificacao_mercado"), rules.market_weight, 0)
    g = g.withColumn("__w", weight)
    order = [F.col("__w").desc(), F.col("roi_estimado_expansao").desc_nulls_last(),
             F.col("tomador_uf").asc(), F.col("tomador_municipio").asc_nulls_first()]
    return global_row_number(g, order, "prioridade_expansao").drop("__w")


# ------------------------------------------------------------------ KPI-1..7
def executive_kpis(inv: DataFrame, rules: Rules = RULES) -> DataFrame:
    month = [F.year("data_emissao").cast("bigint").alias("ano"), F.month("data_emissao").cast("bigint").alias("mes")]
    # Distinct counts in two levels, one branch each: no row is multiplied. The customers'
    # sums are the one large exchange; items are far fewer a month and collapse in each task.
    base = (inv.groupBy(*month, "tomador_cnpj")
            .agg(F.count(F.lit(1)).alias("_rows"), F.sum("valor_liquido").alias("_rec"),
                 F.count("valor_liquido").alias("_n"), _federal_sum().alias("_fed"), F.sum("valor_iss").alias("_iss")))
    sums = [F.sum(c).alias(c) for c in ("_rows", "_rec", "_n", "_fed", "_iss")]
    base = (base.groupBy("ano", "mes").agg(F.count("tomador_cnpj").alias("clientes_unicos"), *sums)
            .withColumnRenamed("_rows", "nfses_emitidas"))
    items = (inv.select(*month, "item_lista_servico").distinct()
             .groupBy("ano", "mes").agg(F.count("item_lista_servico").alias("tipos_servico")))
    same = [base[c].eqNullSafe(items[c]) for c in ("ano", "mes")]
    base = base.join(items, same[0] & same[1]).select(base["*"], "tipos_servico")
    # One row per calendar month: the single-partition window below sees a
    # few hundred rows at most, bounded by the calendar, not by the data.
    w = Window.orderBy(F.col("ano").asc_nulls_first(), F.col("mes").asc_nulls_first())
    frame = w.rowsBetween(-(rules.moving_rows - 1), 0)
    rec = F.col("_rec").cast("double")
    k = base.select(
        "ano", "mes", "nfses_emitidas", "clientes_unicos",
        rec.alias("receita_liquida"),
        mean_of(F.col("_rec"), F.col("_n")).alias("ticket_medio"),
        F.col("_fed").cast("double").alias("impostos_retidos"),
        F.col("_iss").cast("double").alias("iss_total"),
        "tipos_servico",
        F.lag(rec).over(w).alias("receita_mes_anterior"),
        F.lag("clientes_unicos").over(w).alias("clientes_mes_anterior"),
        mean_of(F.sum("_rec").over(frame), F.count("_rec").over(frame)).alias("receita_media_movel_3m"))
    prev = F.col("receita_mes_anterior")
    growth = round_half_away(F.try_divide(F.col("receita_liquida") - prev,
                                          F.when(prev != 0, prev)) * 100, 2)
    k = k.withColumn("growth_rate_receita", growth)
    k = k.select(
        "ano", "mes", "nfses_emitidas", "clientes_unicos", "receita_liquida", "ticket_medio",
        "impostos_retidos", "iss_total", "tipos_servico", "receita_mes_anterior",
        "clientes_mes_anterior", "growth_rate_receita", "receita_media_movel_3m",
        band(F.col("growth_rate_receita"), rules.growth_class, rules.growth_default, ">=")
        .alias("performance_classificacao"),
        (F.col("receita_liquida") * rules.recovery_target).alias("meta_recuperacao_tributaria"),
        round_half_away(F.try_divide(F.col("impostos_retidos"),
                                     F.when(F.col("receita_liquida") != 0, F.col("receita_liquida")))
                        * 100, 2).alias("eficiencia_tributaria_pct"))
    return k


# ------------------------------------------------------------------ OPP-1..7
def sales_opportunities(inv: DataFrame, as_of: str, rules: Rules = RULES) -> DataFrame:
    asof = as_of_lit(as_of)
    keys = ["tomador_cnpj", "tomador_razao_social", "tomador_uf"]
    # The sets below see one row per (customer, item, month), not one per note.
    fine = (inv.filter(F.col("tomador_cnpj").isNotNull())
            .groupBy(*keys, "item_lista_servico",
                     (F.year("data_emissao") * 12 + F.month("data_emissao")).alias("_ym"))
            .agg(F.sum("valor_liquido").alias("_val"), F.count("valor_liquido").alias("_n"),
                 F.count(F.lit(1)).alias("_rows"), F.max("data_emissao").alias("_last")))
    g = (fine.groupBy(*keys)
         .agg(F.collect_set("item_lista_servico").alias("_items"),
              F.sum("_val").alias("_val"),
              F.sum("_n").alias("_n"),
              F.sum("_rows").alias("total_servicos"),
              F.max("_last").alias("ultimo_servico"),
              F.size(F.collect_set("_ym")).cast("bigint").alias("meses_ativos")))
    g = g.select(
        "tomador_cnpj", "tomador_razao_social", "tomador_uf",
        F.size("_items").cast("bigint").alias("tipos_servicos_utilizados"),
        F.array_join(F.array_sort("_items"), ",").alias("lista_servicos"),
        F.col("_val").cast("double").alias("valor_total_cliente"),
        "total_servicos", "ultimo_servico", "meses_ativos",
        mean_of(F.col("_val"), F.col("_n")).alias("ticket_medio_cliente"))
    val, months = F.col("valor_total_cliente"), F.col("meses_ativos")
    up = None
    for amount, mo, score in rules.upsell:
        cond = (val >= amount) & (months >= mo) if mo else (val >= amount)
        up = F.when(cond, score) if up is None else up.when(cond, score)
    days = days_between(asof, F.col("ultimo_servico"))
    g = g.select(
        "*",
        up.otherwise(rules.upsell_default).alias("score_upsell"),
        band(F.col("tipos_servicos_utilizados"), rules.crosssell_score, rules.crosssell_default, "==")
        .alias("score_crosssell"),
        band(days, rules.urgency_days, rules.urgency_default).alias("prioridade_acao"),
        (F.col("ticket_medio_cliente") * rules.extra_revenue_factor).alias("potencial_receita_adicional"))
    wu, wc = rules.final_weights
    final = (F.col("score_upsell") * F.lit(wu).cast("decimal(3,2)")
             + F.col("score_crosssell") * F.lit(wc).cast("decimal(3,2)")).cast("double")
    up_s, cr_s = F.col("score_upsell"), F.col("score_crosssell")
    action = (F.when((cr_s >= 80) & (up_s >= 60), "CROSS_SELL_PRIORITARIO")
              .when(up_s >= 80, "UP_SELL_PRIORITARIO")
              .when(cr_s >= 60, "CROSS_SELL_SECUNDARIO")
              .when(F.col("prioridade_acao") == "URGENTE", "RETENCAO_URGENTE")
              .otherwise("MANUTENCAO"))
    return (g.select("*", final.alias("score_oportunidade_final"), action.alias("recomendacao_acao"))
            .orderBy(F.col("score_oportunidade_final").desc(), F.col("tomador_cnpj"),
                     F.col("tomador_razao_social"), F.col("tomador_uf")))


# ------------------------------------------------------------------ REC-1..6
def tax_recovery(inv: DataFrame, as_of: str, rules: Rules = RULES) -> DataFrame:
    asof = as_of_lit(as_of)
    sums = [("valor_servicos", "valor_servicos_total"), ("valor_liquido", "valor_liquido_total"),
            ("valor_pis", "total_pis"), ("valor_cofins", "total_cofins"),
            ("valor_inss", "total_inss"), ("valor_ir", "total_ir"), ("valor_csll", "total_csll"),
            ("valor_iss", "total_iss"), ("valor_deducoes", "total_deducoes")]
    g = (inv.filter(F.col("tomador_cnpj").isNotNull())
         .groupBy("tomador_cnpj", "tomador_razao_social", "tomador_uf")
         .agg(*[F.sum(s).cast("double").alias(o) for s, o in sums],
              _federal_sum().cast("double").alias("impostos_federais_retidos"),
              F.count(F.lit(1)).alias("total_nfses"),
              F.max("data_emissao").alias("ultima_nfse")))
    fed = F.col("impostos_federais_retidos")
    days = days_between(asof, F.col("ultima_nfse"))
    prio = None
    for amount, max_days, score in rules.recovery_priority:
        cond = (fed >= amount) & (days <= max_days)
        prio = F.when(cond, score) if prio is None else prio.when(cond, score)
    vs = F.col("valor_servicos_total")
    return (g.select(
        "*",
        (fed * rules.recovery_factor).alias("potencial_recuperacao_estimado"),
        round_half_away(F.try_divide(fed, F.when(vs != 0, vs)) * 100, 2).alias("taxa_retencao_pct"),
        band(fed, rules.recovery_class, rules.recovery_class_default, ">=")
        .alias("classificacao_recuperacao"),
        (fed * rules.fee_factor).alias("honorarios_estimados"),
        prio.otherwise(rules.recovery_priority_default).alias("score_prioridade_recuperacao"))
        .orderBy(fed.desc(), F.col("tomador_cnpj"), F.col("tomador_razao_social"), F.col("tomador_uf")))
