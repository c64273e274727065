"""Portfolio summaries over a scored table (one global or grouped aggregation each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput import presets

MONEY = "decimal(38,2)"


def kpi_columns(p: str = "probability") -> list:
    """The aggregates of A1. Money is summed as DECIMAL so the total does not depend on summation order."""
    n = F.count(F.lit(1))
    pred = F.count_if(F.col(p) >= presets.DECISION_THRESHOLD)
    return [
        n.alias("customers"),
        pred.alias("predicted_attrition"),
        F.try_divide(pred.cast("double") * 100, n.cast("double")).alias("predicted_attrition_pct"),
        F.count_if(F.col("risk_tier").isin("HIGH", "CRITICAL")).alias("high_critical"),
        F.sum(F.col("clv_at_risk").cast(MONEY)).cast("double").alias("clv_at_risk_total"),
    ]


def kpis(scored: DataFrame, p: str = "probability") -> DataFrame:
    """A1: customers, predicted leavers and share (p >= 0.5), HIGH+CRITICAL count, CLV at risk."""
    return scored.agg(*kpi_columns(p))


def tier_order(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in enumerate(presets.TIER_ORDER)],
                                 "tier_rank int, risk_tier string")


def tier_distribution(scored: DataFrame) -> DataFrame:
    """A2: count and CLV at risk per tier in LOW < MEDIUM < HIGH < CRITICAL order, zero-filled.

    The per-tier aggregate (<= 4 rows) is joined to the 4-row order table.
    """
    spark = scored.sparkSession
    agg = scored.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("clv_at_risk").cast(MONEY)).cast("double").alias("clv_at_risk"))
    return (tier_order(spark).join(F.broadcast(agg), "risk_tier", "left")
            .select("tier_rank", "risk_tier",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("customers"),
                    F.coalesce("clv_at_risk", F.lit(0.0)).alias("clv_at_risk"))
            .orderBy("tier_rank"))


def histogram_bin(pct: str = "attrition_probability", bins: int = 30):
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col(pct) / F.lit(100.0 / bins)).cast("int")))


def probability_histogram(scored: DataFrame, pct: str = "attrition_probability", bins: int = 30) -> DataFrame:
    """A3: fixed-width histogram of the percent probability on [0, 100], ``bins`` bins."""
    width = 100.0 / bins
    b = histogram_bin(pct, bins)
    return (scored.where(F.col(pct).isNotNull())
            .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
            .select("bin", (F.col("bin") * F.lit(width)).alias("bin_start"), "customers")
            .orderBy("bin"))


def top_risk(scored: DataFrame, n: int = 10, key: str = "customerID") -> DataFrame:
    """A4: the n highest probabilities (top-k; ties broken by key)."""
    return (scored.orderBy(F.desc("attrition_probability"), F.asc(key)).limit(n)
            .select(key, "attrition_probability", "risk_tier", "clv_at_risk",
                    "Contract", "tenure", "MonthlyCharges"))


def high_risk(scored: DataFrame, cut: float = 50.0) -> DataFrame:
    """Rows with percent probability >= cut."""
    return scored.where(F.col("attrition_probability") >= cut)
