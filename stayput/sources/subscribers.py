"""Subscriber view derived from the ``customer`` table.

A deterministic mapping of each ``customer`` row onto the 20-column
subscriber record plus ``Departed``. It is a narrow projection (no shuffle), so
it scales with the customer table; the same rule is written as SQL in
``stayput.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput.session import table_path

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _yes_no(cond):
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def _service(internet, cond):
    return (F.when(internet == "No", F.lit("No internet service"))
            .when(cond, F.lit("Yes")).otherwise(F.lit("No")))


def subscribers_from_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    nk = F.col("c_nationkey")
    base = customer.select(
        "c_custkey",
        F.col("c_name").alias("customerID"),
        "c_nationkey",
        ((k * 37) % 73).cast("int").alias("tenure"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("One year"))
         .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Two year"))
         .otherwise(F.lit("Month-to-month")).alias("Contract"),
        F.when(nk % 5 == 0, F.lit("No"))
         .when((nk % 5).isin(1, 2), F.lit("DSL"))
         .otherwise(F.lit("Fiber optic")).alias("InternetService"),
        F.when(k % 4 == 0, F.lit("Electronic check"))
         .when(k % 4 == 1, F.lit("Mailed check"))
         .when(k % 4 == 2, F.lit("Bank transfer (automatic)"))
         .otherwise(F.lit("Credit card (automatic)")).alias("PaymentMethod"),
        F.when(k % 10 == 9, F.lit("No")).otherwise(F.lit("Yes")).alias("PhoneService"),
        F.when(k % 29 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(18.25) + (F.col("c_acctbal") + 1000) / 100).alias("MonthlyCharges"),
    )
    inet = F.col("InternetService")
    t = F.col("tenure")
    risk_points = (
        F.when(F.col("Contract") == "Month-to-month", 1).otherwise(0)
        + F.when(F.col("PaymentMethod") == "Electronic check", 1).otherwise(0)
        + F.when(inet == "Fiber optic", 1).otherwise(0)
        + F.when(t < 12, 1).otherwise(0)
    )
    return base.select(
        "c_custkey", "customerID",
        F.when(k % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")).alias("gender"),
        F.when(k % 6 == 0, F.lit(1)).otherwise(F.lit(0)).alias("SeniorCitizen"),
        _yes_no(nk % 2 == 0).alias("Partner"),
        _yes_no(nk % 3 == 0).alias("Dependents"),
        "tenure", "PhoneService",
        F.when(F.col("PhoneService") == "No", F.lit("No phone service"))
         .when(k % 3 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("MultipleLines"),
        "InternetService",
        _service(inet, k % 7 < 2).alias("OnlineSecurity"),
        _service(inet, k % 7 < 3).alias("OnlineBackup"),
        _service(inet, k % 11 < 4).alias("DeviceProtection"),
        _service(inet, k % 11 < 3).alias("TechSupport"),
        _service(inet, k % 13 < 5).alias("StreamingTV"),
        _service(inet, k % 13 < 6).alias("StreamingMovies"),
        "Contract",
        _yes_no(k % 5 < 3).alias("PaperlessBilling"),
        "PaymentMethod", "MonthlyCharges",
        F.when(t == 0, F.lit(None).cast("double"))
         .otherwise(t * F.col("MonthlyCharges")).alias("TotalCharges"),
        _yes_no(20 * risk_points + (k * 13) % 50 >= 65).alias("Departed"),
    )


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber view over ``{sf_dir}/customer.parquet`` (only the 5 used columns are read)."""
    customer = spark.read.parquet(table_path(sf_dir, "customer")).select(*CUSTOMER_COLUMNS)
    return subscribers_from_customers(customer)
