"""End to end, as the hold-out flow: CSV in -> train -> evaluate -> save / load -> rescore -> report."""

import tempfile

from pyspark.sql import functions as F

from stayput import catalog
from stayput.operators import decide, evaluate
from stayput.plans import batch_report, training
from stayput.plans.feature_plan import FeaturePlan
from stayput.sources import io
from tests.conftest import SF01


def test_train_score_report_reload(spark):
    d = tempfile.mkdtemp(prefix="stayput-e2e-")
    io.write_table(catalog._records(spark, SF01), f"{d}/customers.csv", "csv")
    raw = io.read_customers(spark, f"{d}/customers.csv")

    tm = training.fit(raw, space=training.SMALL_SEARCH, n_candidates=2, k=2)
    ev = {r["split"]: r for r in training.evaluate_splits(tm).collect()}
    assert set(ev) == {"train", "val", "test"}
    assert ev["test"]["roc_auc"] >= 0.75

    scorer = training.model_scorer(tm)
    scored = decide.with_value_at_risk(scorer(raw))
    rep = batch_report.batch_report(scored, sink=f"{d}/scored")
    k = rep["kpis"].first()
    assert k["customers"] == 1500
    assert sum(r["customers"] for r in rep["tiers"].collect()) == 1500
    assert spark.read.option("header", True).csv(f"{d}/scored").count() == 1500

    # confusion details on the held-out rows, with decoded labels
    test_rows = scorer(raw.join(tm.data.where(F.col("split") == "test").select("customerID"), "customerID", "left_semi"))
    held = test_rows.select("customerID", F.when(F.col("Departed") == "Yes", 1).otherwise(0).alias("y"),
                            (F.col("probability") >= 0.5).cast("int").alias("yhat"))
    types = {r["confusion_type"]: r["n"] for r in evaluate.confusion_type_counts(held, "y", "yhat").collect()}
    assert sum(types.values()) == held.count() and "Unknown" not in types

    # state and model saved, loaded, and the scores are equal
    io.save_state(tm.plan.state_tables(spark), f"{d}/model", tm.model)
    tables, model = io.load_state(spark, f"{d}/model")
    again = training.TrainedModel(FeaturePlan.from_tables(tables), model, tm.params, tm.candidates, None, tm.data)
    a = scorer(raw).select("customerID", "probability")
    b = training.model_scorer(again)(raw).select("customerID", "probability")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
