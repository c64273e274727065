"""Row-level feature engineering (F1-F17): narrow projections only.

Each ``add_*`` adds one feature when its input columns exist (the "add only
if present" rule); ``engineer`` applies F1-F12 in the trained order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput import presets
from stayput.functions.columns import (bin_right_closed, count_where, flag, map_lookup,
                                       not_in_null_true, row_sum)


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def add_tenure_group(df: DataFrame, col: str = "tenure") -> DataFrame:
    """right-closed tenure bins (0,12] -> 0 ... (60,72] -> 5, else -1."""
    return df.withColumn("tenure_group", bin_right_closed(col, presets.TENURE_EDGES))


def add_tenure_to_max(df: DataFrame, col: str = "tenure") -> DataFrame:
    """tenure / 72."""
    return df.withColumn("tenure_to_max", F.col(col) / F.lit(presets.TENURE_MAX))


def add_tenure_monthly_ratio(df: DataFrame, tenure: str = "tenure", monthly: str = "MonthlyCharges") -> DataFrame:
    """tenure / (monthly + 1); a zero denominator gives null instead of an ANSI error."""
    return df.withColumn("tenure_monthly_ratio",
                         F.try_divide(F.col(tenure).cast("double"), F.col(monthly) + F.lit(1)))


def add_charge_group(df: DataFrame, col: str = "MonthlyCharges") -> DataFrame:
    """right-closed charge bins (0,30] -> 0 ... (90,120] -> 3, else -1."""
    return df.withColumn("charge_group", bin_right_closed(col, presets.CHARGE_EDGES))


def add_total_services(df: DataFrame, cols: Sequence[str] = presets.SERVICE_COLUMNS) -> DataFrame:
    """services whose value is not "No"/"No internet service" (a null counts as active)."""
    avail = [c for c in cols if c in df.columns]
    return df.withColumn("total_services",
                         count_where(avail, lambda c: not_in_null_true(c, presets.INACTIVE_SERVICE_VALUES)))


def add_indicator(df: DataFrame, name: str, cond) -> DataFrame:
    return df.withColumn(name, flag(cond))


# (feature, input column, condition); null never matches
INDICATORS = [
    ("has_internet", "InternetService", lambda c: c.isin(*presets.INTERNET_VALUES)),
    ("has_phone", "PhoneService", lambda c: c == "Yes"),
    ("is_month_to_month", "Contract", lambda c: c == "Month-to-month"),
    ("is_automatic_payment", "PaymentMethod", lambda c: c.contains(presets.AUTOMATIC_MARKER)),
    ("is_senior", "SeniorCitizen", lambda c: c == 1),
    ("has_dependents", "Dependents", lambda c: c == "Yes"),
]


def add_named_indicator(df: DataFrame, name: str) -> DataFrame:
    for n, col, cond in INDICATORS:
        if n == name:
            return add_indicator(df, name, cond(F.col(col)))
    raise KeyError(name)


def add_attrition_risk_score(df: DataFrame, parts=presets.RISK_SCORE_PARTS) -> DataFrame:
    """sum of the risk flags present (month-to-month, electronic check, fiber)."""
    flags = [flag(F.col(c) == v) for c, v in parts if c in df.columns]
    if not flags:
        return df
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    return df.withColumn("attrition_risk_score", total)


def engineer(df: DataFrame) -> DataFrame:
    """F1-F12 in the trained feature order, each only when its inputs exist."""
    out = df
    if _has(out, "tenure"):
        out = add_tenure_group(out)
        out = add_tenure_to_max(out)
        if _has(out, "MonthlyCharges"):
            out = add_tenure_monthly_ratio(out)
    if _has(out, "MonthlyCharges"):
        out = add_charge_group(out)
    if any(c in out.columns for c in presets.SERVICE_COLUMNS):
        out = add_total_services(out)
    for name, col, cond in INDICATORS:
        if _has(out, col):
            out = add_indicator(out, name, cond(F.col(col)))
    return add_attrition_risk_score(out)


# ---------------------------------------------------------------------------
# F13 z-score (fit / apply)
# ---------------------------------------------------------------------------
def fit_zscore(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, float]]:
    """F13 fit: mean and sample std per column in one aggregation."""
    if not cols:
        return {}
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return {c: {"mean": row[f"m_{i}"], "std": row[f"s_{i}"]} for i, c in enumerate(cols)}


def apply_zscore(df: DataFrame, stats: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """F13 apply: ``<col>_zscore`` = (x - mean) / std, skipped when std is 0 or undefined."""
    adds = [((F.col(c) - F.lit(s["mean"])) / F.lit(s["std"])).alias(f"{c}_zscore")
            for c, s in stats.items()
            if c in df.columns and s.get("std") is not None and s["std"] > 0]
    return df.select("*", *adds)


# ---------------------------------------------------------------------------
# The alternative (signed) feature set
# ---------------------------------------------------------------------------
def add_avg_charge(df: DataFrame, total: str = "TotalCharges", tenure: str = "tenure",
                   monthly: str = "MonthlyCharges") -> DataFrame:
    """total / tenure when tenure > 0, else monthly."""
    return df.withColumn("AvgCharge", F.when(F.col(tenure) > 0, F.col(total) / F.col(tenure))
                         .otherwise(F.col(monthly)))


def add_charge_diff(df: DataFrame, monthly: str = "MonthlyCharges") -> DataFrame:
    """monthly - AvgCharge."""
    return df.withColumn("ChargeDiff", F.col(monthly) - F.col("AvgCharge"))


def signed_encode(df: DataFrame, maps: Mapping[str, Mapping] = presets.SIGNED_MAPS) -> DataFrame:
    """F16: per-column value maps (+1 / -1 / 0); unmapped values become null."""
    return df.select(*[map_lookup(c, maps[c]).cast("int").alias(c) if c in maps else F.col(c)
                       for c in df.columns])


def add_total_count(df: DataFrame, cols: Sequence[str] = presets.SIGNED_COUNT_EVAL) -> DataFrame:
    """null-skipping row sum of the mapped columns."""
    return df.withColumn("total_count", row_sum([c for c in cols if c in df.columns]).cast("bigint"))
