"""Star-schema marts: customer dimension, billing fact, calendar, monitors.

DIM-1..10, FCT-1, TIM-1, VST-1, VRS-1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import RULES, Rules
from ..functions.exprs import (as_of_lit, band, days_between, mean_of, months_before,
                               round_half_away, tail_city_state, week_sunday)
from .rank import global_row_number

EXACT = "decimal(38,9)"  # exact summation of double money values


def exact(c: str) -> Column:
    """A double money value for exact sums; what the type can't hold (non-finite, 30
    digits and more) is NULL and is not counted either."""
    return F.col(c).try_cast(EXACT)


COMPANY_ATTRS = ("razao_social", "nome_fantasia", "situacao_cadastral", "data_situacao", "endereco")


def latest_companies(companies: DataFrame) -> DataFrame:
    """DIM-1: newest record per cnpj (a newer NULL beats an older value).

    ``max_by`` over a struct is a plain aggregate, so it combines map-side:
    a cnpj with millions of versions never lands whole in one task."""
    valid = companies.filter(F.col("cnpj").isNotNull() & (F.col("cnpj") != ""))
    latest = valid.groupBy("cnpj").agg(
        F.max_by(F.struct(*COMPANY_ATTRS),
                 F.struct("_ingestion_timestamp", "arquivo_nome", "linha_original")).alias("_l"))
    return latest.select("cnpj", *[F.col("_l." + a).alias(a) for a in COMPANY_ATTRS])


def billing_by_customer(billing: DataFrame) -> DataFrame:
    """DIM-2: first/last date, count, sum, mean per cnpj."""
    valid = billing.filter(F.col("cnpj").isNotNull() & (F.col("cnpj") != ""))
    g = valid.groupBy("cnpj").agg(
        F.min("data_emissao").alias("primeira_nota"),
        F.max("data_emissao").alias("ultima_nota"),
        F.count(F.lit(1)).alias("total_notas"),
        F.sum(exact("valor_liquido")).alias("_sum"),
        F.count(exact("valor_liquido")).alias("_n"))
    return g.select("cnpj", "primeira_nota", "ultima_nota", "total_notas",
                    F.col("_sum").cast("double").alias("faturamento_total"),
                    mean_of(F.col("_sum"), F.col("_n")).alias("ticket_medio"))


def customer_status(last: Column, as_of: Column, rules: Rules = RULES) -> Column:
    e = None
    for months, label in rules.status_months:
        cond = last >= months_before(as_of, months)
        e = F.when(cond, label) if e is None else e.when(cond, label)
    return e.when(last.isNotNull(), rules.status_old).otherwise(rules.status_none)


def dim_customers(billing: DataFrame, companies: DataFrame, as_of: str,
                  rules: Rules = RULES, load_timestamp: bool = False) -> DataFrame:
    """``dim_clientes``: companies ⟗ billing on cnpj, ranked by revenue.

    Both sides are aggregated by cnpj, so the full outer join reuses that
    hash partitioning (no extra exchange). The surrogate key is the
    distributed global row number (RNK-1), tie-broken by cnpj."""
    asof = as_of_lit(as_of)
    j = latest_companies(companies).join(billing_by_customer(billing), "cnpj", "full_outer")
    j = j.filter(F.col("cnpj").isNotNull())
    ranked = global_row_number(
        j, [F.coalesce(F.col("faturamento_total"), F.lit(0.0)).desc(), F.col("cnpj").asc()],
        "cliente_key")
    cidade, uf = tail_city_state(F.col("endereco"))
    cols = [
        "cliente_key", "cnpj",
        F.coalesce(F.col("razao_social"), F.lit(C.NAME_DEFAULT)).alias("razao_social"),
        "nome_fantasia", "situacao_cadastral", "data_situacao", "endereco",
        cidade.alias("cidade"), uf.alias("uf"),
        "primeira_nota", "ultima_nota", "total_notas", "faturamento_total", "ticket_medio",
        customer_status(F.col("ultima_nota"), asof, rules).alias("status_cliente"),
        days_between(asof, F.col("ultima_nota")).alias("dias_sem_nota"),
        band(F.col("faturamento_total"), rules.segment, rules.segment_default, ">").alias("segmento_valor"),
    ]
    if load_timestamp:
        cols.append(F.current_timestamp().alias("ultima_atualizacao"))
    return ranked.select(*cols)


def fact_billing(billing: DataFrame, dim: DataFrame) -> DataFrame:
    """``fato_faturamento``: billing ⟕ dimension on cnpj (dimension is unique
    per cnpj, so no fan-out). Blank cnpj can never match; those rows get a
    spread-out salt key instead of one hot '' key in the join shuffle."""
    salt = F.concat(F.lit("#"), F.pmod(F.xxhash64("arquivo_nome", "linha_original"), F.lit(4096))
                    .cast("string"))
    left = billing.withColumn("__jk", F.when(F.col("cnpj") != "", F.col("cnpj")).otherwise(salt))
    right = dim.select(F.col("cnpj").alias("__jk"), "cliente_key")
    f = left.join(right, "__jk", "left")
    d = F.col("data_emissao")
    return f.select(
        "cnpj", "cliente_key", "data_emissao",
        F.date_format(d, "yyyyMMdd").alias("data_key"),
        "numero_nota", "tipo_servico", "situacao", "valor_liquido", "valor_bruto", "honorarios",
        "consultor",
        F.year(d).cast("bigint").alias("ano"), F.month(d).cast("bigint").alias("mes"),
        F.quarter(d).cast("bigint").alias("trimestre"),
        F.col("arquivo_nome").alias("source_file"),
        "_ingestion_timestamp", "_ingestion_batch_id")


def calendar_from_bounds(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """TIM-1 over a one-row (start, end) frame: one row per day, inclusive."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("data"))
    d = F.col("data")
    dow = F.dayofweek(d)
    return days.select(
        F.date_format(d, "yyyyMMdd").alias("data_key"), "data",
        F.year(d).cast("bigint").alias("ano"), F.quarter(d).cast("bigint").alias("trimestre"),
        F.month(d).cast("bigint").alias("mes"), F.date_format(d, "MMMM").alias("nome_mes"),
        week_sunday(d).alias("semana"), dow.cast("bigint").alias("dia_semana"),
        F.date_format(d, "EEEE").alias("nome_dia_semana"),
        dow.isin(1, 7).alias("eh_fim_de_semana"))


def dim_calendar(spark: SparkSession, start: str = C.CALENDAR_START,
                 end: str = C.CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"),
                                   F.lit(end).cast("date").alias("end"))
    return calendar_from_bounds(bounds)


def calendar_covering(dates: DataFrame, column: str = "data_emissao",
                      start: str = C.CALENDAR_START, end: str = C.CALENDAR_END) -> DataFrame:
    """Calendar spanning the fixed range widened to the data's own date range."""
    b = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(
        F.least(F.coalesce(F.col("lo"), F.lit(start).cast("date")), F.lit(start).cast("date")).alias("start"),
        F.greatest(F.coalesce(F.col("hi"), F.lit(end).cast("date")), F.lit(end).cast("date")).alias("end"))
    return calendar_from_bounds(b)


def ingestion_status(raw: DataFrame) -> DataFrame:
    """VST-1 ``vw_status_ingestao``."""
    return (raw.groupBy("arquivo_tipo", "_processing_status")
            .agg(F.count(F.lit(1)).alias("total_linhas"),
                 F.countDistinct("arquivo_nome").alias("total_arquivos"),
                 F.min("data_emissao").alias("data_mais_antiga"),
                 F.max("data_emissao").alias("data_mais_recente"),
                 F.sum(exact("valor")).cast("double").alias("valor_total"))
            .orderBy("arquivo_tipo", "_processing_status"))


def customer_summary(dim: DataFrame) -> DataFrame:
    """VRS-1 ``vw_resumo_clientes`` (mean of per-customer tickets, as in the reference).

    Each ticket is rounded to 6 decimals and summed exactly, so the mean does
    not depend on the order rows reach the aggregate (deviation < 1e-6)."""
    return (dim.groupBy("status_cliente", "segmento_valor")
            .agg(F.count(F.lit(1)).alias("total_clientes"),
                 F.sum(F.col("faturamento_total").cast(EXACT)).cast("double").alias("faturamento_total"),
                 mean_of(F.sum(round_half_away(F.col("ticket_medio"), 6).cast("decimal(38,6)")),
                         F.count("ticket_medio")).alias("ticket_medio"),
                 F.avg("dias_sem_nota").alias("media_dias_sem_nota"))
            .orderBy("status_cliente", "segmento_valor"))
