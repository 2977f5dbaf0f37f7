"""Documented client score and reports (OPS-1..5), over the customer mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import RULES, Rules
from ..functions.exprs import band, document_scalars, document_value, lookup, round_half_away


def client_score(dim: DataFrame, rules: Rules = RULES) -> DataFrame:
    """OPS-1..3: 0-100 score, class and recommended action per customer.
    Bands the prose leaves unspecified score 0."""
    fat = F.coalesce(F.col("faturamento_total"), F.lit(0.0))
    notes = F.coalesce(F.col("total_notas"), F.lit(0))
    score = (lookup(F.col("situacao_cadastral"), rules.score_registration, 0)
             + band(fat, rules.score_revenue, 0, ">=") + band(notes, rules.score_notes, 0, ">="))
    s = F.col("score_cliente")
    cls = None
    for min_score, min_fat, label in rules.client_class:
        cond = (s >= min_score) & (fat >= min_fat)
        cls = F.when(cond, label) if cls is None else cls.when(cond, label)
    cls = (cls.when(F.col("status_cliente") == "ATIVO", rules.class_active_low)
              .when(F.col("ultima_nota").isNotNull(), rules.class_inactive)
              .otherwise(rules.class_other))
    act = None
    for min_fat, label in rules.action_revenue:
        act = F.when(fat >= min_fat, label) if act is None else act.when(fat >= min_fat, label)
    act = (act.when(F.col("classificacao_cliente") == rules.class_inactive, rules.action_reactivate)
              .otherwise(rules.action_default))
    out = dim.select("cnpj", "razao_social", "situacao_cadastral", "status_cliente", "total_notas",
                     "faturamento_total", "ultima_nota", score.alias("score_cliente"))
    out = out.withColumn("classificacao_cliente", cls)
    return out.withColumn("acao_recomendada", act).drop("ultima_nota")


def top_opportunities(scored: DataFrame,
                      classes: Sequence[str] = ("OPORTUNIDADE_PREMIUM", "OPORTUNIDADE_ALTA"),
                      k: int | None = None) -> DataFrame:
    """OPS-4: premium/high opportunities by revenue; ``k`` makes it a top-k
    report (planned as TakeOrderedAndProject, no global sort)."""
    out = (scored.filter(F.col("classificacao_cliente").isin(*classes))
           .select("cnpj", "razao_social", "score_cliente", "faturamento_total", "classificacao_cliente")
           .orderBy(F.col("faturamento_total").desc(), F.col("cnpj")))
    return out.limit(k) if k else out


def validation_progress(raw: DataFrame, status_key: str = "Status", status_ok: str = "OK") -> DataFrame:
    """OPS-5: rows of the old-companies table with status OK: total,
    validated (company name present) and percent to one decimal."""
    r = raw.filter((F.col("arquivo_tipo") == C.TYPE_OLD_COMPANIES)
                   & (F.col("_processing_status") == C.STATUS_PROCESSED))
    r = r.select(F.explode(F.array(document_scalars("dados_json"))).alias("__doc"))
    ok = r.filter(document_value(F.col("__doc"), status_key) == status_ok)
    name = F.coalesce(*[document_value(F.col("__doc"), k) for k in C.KEYS_RAZAO])
    agg = ok.agg(F.count(F.lit(1)).alias("total"), F.count(name).alias("validados"))
    return agg.select("total", "validados",
                      round_half_away(F.try_divide(F.col("validados").cast("double") * 100,
                                                   F.col("total")), 1).alias("percentual"))


def daily_report(kpis: DataFrame, scored: DataFrame, path: str, k: int | None = None) -> None:
    """OPS-6: the daily executive report written out (KPIs by month and the
    opportunities, all or the top k); delivery (e-mail) is not part of this engine."""
    kpis.write.mode("overwrite").parquet(f"{path}/kpis")
    top_opportunities(scored, k=k).write.mode("overwrite").parquet(f"{path}/oportunidades")
