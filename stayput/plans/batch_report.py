"""A5: batch scoring report — the scored table is written once and its summaries are counted as it is written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stayput import presets
from stayput.operators import portfolio
from stayput.session import scratch
from stayput.sources import io

BINS = 30


def batch_report(scored: DataFrame, sink: str | None = None, top_n: int = 10, fmt: str = "csv") -> dict[str, DataFrame]:
    """``scored`` must carry probability, attrition_probability, risk_tier, clv_at_risk.

    One job scores the rows, writes them to ``sink`` (parquet in the shared folder if none is named) and observes the KPI row, the tier
    distribution and the histogram on the way, so nothing is kept in memory and nothing is scored twice. The top rows and
    "scored" itself are read from what was written. The numbers are those of ``portfolio``'s aggregations; an empty table has zero rows and
    empty bins.
    """
    spark = scored.sparkSession
    seen = Observation(f"report-{uuid.uuid4().hex}")
    tier, money = F.col("risk_tier"), F.col("clv_at_risk").cast(portfolio.MONEY)
    counted = scored.withColumn("_bin", portfolio.histogram_bin(bins=BINS)).observe(
        seen, *portfolio.kpi_columns(),
        *[F.count_if(tier == t).alias(f"n_{t}") for t in presets.TIER_ORDER],
        *[F.sum(F.when(tier == t, money)).cast("double").alias(f"clv_{t}") for t in presets.TIER_ORDER],
        *[F.count_if(F.col("_bin") == b).alias(f"bin_{b}") for b in range(BINS)]).drop("_bin")
    path, kind = (sink, fmt) if sink else (f"{scratch(spark, 'report')}/scored", "parquet")
    io.write_table(counted, path, kind)
    found = seen.get
    reader = spark.read.schema(scored.schema)
    written = reader.option("header", True).csv(path) if kind == "csv" else reader.format(kind).load(path)
    kpis = spark.createDataFrame([tuple(found[c] for c in ("customers", "predicted_attrition", "predicted_attrition_pct", "high_critical",
                                                           "clv_at_risk_total"))],
                                 "customers long, predicted_attrition long, predicted_attrition_pct double, high_critical long, clv_at_risk_total double")
    tiers = spark.createDataFrame([(i, t, found[f"n_{t}"], found[f"clv_{t}"] or 0.0) for i, t in enumerate(presets.TIER_ORDER)],
                                  "tier_rank int, risk_tier string, customers long, clv_at_risk double")
    width = 100.0 / BINS
    histogram = spark.createDataFrame([(b, b * width, found[f"bin_{b}"]) for b in range(BINS) if found[f"bin_{b}"]],
                                      "bin int, bin_start double, customers long")
    return {"scored": written, "kpis": kpis, "tiers": tiers, "histogram": histogram, "top": portfolio.top_risk(written, top_n)}


def sections(report: dict[str, DataFrame]) -> DataFrame:
    """(section, position, item, customers, value): the summaries of a report as one table."""
    k, t, h, top = (report[x] for x in ("kpis", "tiers", "histogram", "top"))
    zero = F.lit(0).cast("long")
    names = ["predicted_attrition", "predicted_attrition_pct", "high_critical", "clv_at_risk_total"]
    rows = k.select(F.posexplode(F.array(*[F.struct(F.lit(c).alias("item"), F.col("customers"), F.col(c).cast("double").alias("value")) for c in names]))
                    .alias("position", "r")).select(F.lit("kpi").alias("section"), "position", "r.*")
    rows = rows.unionByName(t.select(F.lit("tier").alias("section"), F.col("tier_rank").alias("position"), F.col("risk_tier").alias("item"), "customers",
                                     F.col("clv_at_risk").alias("value")))
    rows = rows.unionByName(h.select(F.lit("histogram").alias("section"), F.col("bin").alias("position"), F.lit("").alias("item"), "customers",
                                     F.col("bin_start").alias("value")))
    # the top rows are few: one row each
    listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("attrition_probability")).alias("p"), "customerID"))).alias("r")) \
        .select(F.posexplode("r").alias("position", "r"))
    return rows.unionByName(listed.select(F.lit("top").alias("section"), "position", F.col("r.customerID").alias("item"), zero.alias("customers"),
                                          (-F.col("r.p")).alias("value")))
