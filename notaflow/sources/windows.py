"""SRC-12 re-aimed: the historic extraction window plan and its coverage.

The reference walks back ``months * 30`` days and queries windows of 30 days,
the next one starting the day after the previous end. Here the plan is a
small DataFrame (one row per window, bounded by months) and each invoice is
mapped to its window by arithmetic on its date — an equi-join, not a range
join — so a failed (empty) window shows up as a coverage gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RULES


def window_plan(spark: SparkSession, as_of: str, months: int = RULES.history_months,
                window_days: int = RULES.window_days) -> DataFrame:
    step = window_days + 1
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, months * 30)
    n = (months * 30) // step + 1
    plan = spark.range(n).select(F.col("id").alias("janela"))
    plan = plan.select("janela", F.date_add(start, (F.col("janela") * step).cast("int")).alias("inicio"))
    plan = plan.filter(F.col("inicio") < end)
    return plan.select("janela", "inicio", F.least(F.date_add("inicio", window_days), end).alias("fim"))


def coverage(invoices: DataFrame, as_of: str, months: int = RULES.history_months,
             window_days: int = RULES.window_days, date_col: str = "data_emissao") -> DataFrame:
    """Per window: notes landed and a gap flag (no notes at all)."""
    spark = invoices.sparkSession
    plan = window_plan(spark, as_of, months, window_days)
    step = window_days + 1
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, months * 30)
    d = F.col(date_col)
    k = F.floor(F.datediff(d, start) / step).cast("bigint")
    counts = (invoices.filter((d >= start) & (d <= end))
              .groupBy(k.alias("janela")).agg(F.count(F.lit(1)).alias("notas")))
    return (plan.join(counts, "janela", "left")
            .select("janela", "inicio", "fim", F.coalesce("notas", F.lit(0)).cast("bigint").alias("notas"),
                    F.col("notas").isNull().alias("lacuna")))
