"""Invariants from the test strategy: metric symmetries, split shares, support totals,
state round trip, and running totals against a brute-force reference on random data."""

import random

import pandas as pd
from pyspark.sql import functions as F

from stayput import catalog, presets
from stayput.operators import evaluate, split
from stayput.operators.ordered import running_totals
from stayput.plans.feature_plan import FeaturePlan
from tests.conftest import SF001, SF01


def test_auc_of_complement(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("s"))
    a = evaluate.ranking_metrics(li, "y", "s").first()["roc_auc"]
    b = evaluate.ranking_metrics(li.withColumn("s", -F.col("s")), "y", "s").first()["roc_auc"]
    assert abs(a + b - 1.0) < 1e-12


def test_split_shares_and_determinism(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderstatus")
    s = split.stratified_split(o, "o_orderkey", "o_orderstatus", bucket_bits=3)
    got = {(r[0], r[1]): r[2] for r in s.groupBy("o_orderstatus", "split").count().collect()}
    sizes = {r[0]: r[1] for r in o.groupBy("o_orderstatus").count().collect()}
    for cls, n in sizes.items():
        assert abs(got.get((cls, "train"), 0) - 0.6 * n) <= 1
        assert abs(got.get((cls, "val"), 0) - 0.2 * n) <= 1
        assert sum(got.get((cls, k), 0) for k in ("train", "val", "test")) == n
    again = split.stratified_split(o, "o_orderkey", "o_orderstatus")
    assert s.exceptAll(again).count() == 0     # same rows, whatever the bucketing
    folds = split.assign_folds(o, "o_orderkey", "o_orderstatus", k=5)
    per = folds.groupBy("o_orderstatus", "fold").count().groupBy("o_orderstatus") \
        .agg((F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in per)


def test_support_sums_to_rows(spark):
    lb = spark.read.parquet(f"{SF01}/labels.parquet").select(
        F.col("quality").alias("y"), (1 - F.col("toxic")).alias("p"))
    rep = {r["class"]: r["support"] for r in evaluate.classification_report(lb, "y", "p").collect()}
    assert rep["0"] + rep["1"] == rep["accuracy"] == lb.count()


def test_plan_state_round_trip(spark, tmp_path):
    from stayput.sources import io
    s = catalog._records(spark, SF001)
    plan = FeaturePlan(target=presets.TARGET, id_columns=["customerID"]).fit(s)
    io.save_state(plan.state_tables(spark), str(tmp_path))
    tables, model = io.load_state(spark, str(tmp_path))
    assert model is None
    again = FeaturePlan.from_tables(tables)
    a = plan.features(s)
    b = again.features(s)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # transform is idempotent on the fitted data: fitting again gives the same output
    c = FeaturePlan(target=presets.TARGET, id_columns=["customerID"]).fit(s).features(s)
    assert a.exceptAll(c).count() == 0


def test_running_totals_random(spark):
    rng = random.Random(7)
    for trial in range(3):
        rows = [(rng.choice(["a", "b", "c"]), float(rng.randint(0, 40)), rng.randint(0, 5)) for _ in range(400)]
        pdf = pd.DataFrame(rows, columns=["g", "v", "w"]).groupby(["g", "v"], as_index=False)["w"].sum()
        df = spark.createDataFrame(pdf)
        desc = trial % 2 == 0
        out = running_totals(df, "v", ["w"], by=["g"], descending=desc, next_cols=["w"],
                             rows_per_bucket=rng.choice([1, 7, 1000])).toPandas()
        exp = pdf.sort_values(["g", "v"], ascending=[True, not desc]).copy()
        exp["cum_w"] = exp.groupby("g")["w"].cumsum()
        exp["next_w"] = exp.groupby("g")["w"].shift(-1)
        m = exp.merge(out, on=["g", "v"], suffixes=("", "_got"))
        assert len(m) == len(pdf)
        assert (m["cum_w"] == m["cum_w_got"]).all()
        assert ((m["next_w"] == m["next_w_got"]) | (m["next_w"].isna() & m["next_w_got"].isna())).all()
