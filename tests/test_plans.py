"""Plan checks: no Python evaluation, no Cartesian / nested-loop joins, column pruning at the scan."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
QUERIES = ["a5_batch_report", "v3_roc_auc_lineitem", "v6_roc_curve", "v14_evaluation_bundle",
           "t1_stratified_split_orders", "t3_kfold", "c3_median_table_lineitem", "e2_label_encode_unseen",
           "d5_risk_drivers", "d6_retention_playbook", "d7_scenario_impact", "d8_best_action",
           "a2_tier_distribution", "e11_feature_plan"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node} in plan"


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["v3_roc_auc_lineitem"](spark, SF001))
    assert "ReadSchema: struct<l_discount:double,l_returnflag:string>" in plan
    plan = _plan(E.queries()["d7_scenario_impact"](spark, SF001))
    assert "c_address" not in plan and "c_phone" not in plan


@pytest.mark.parametrize("name", ["e11_feature_plan", "d5_risk_drivers", "d7_scenario_impact",
                                  "m3_ensemble_score", "f16_signed_encode", "e2_label_encode_unseen"])
def test_narrow_plans_have_no_shuffle(spark, name):
    """Transform-side operators are a scan plus projections / explode: no Exchange at all."""
    plan = _plan(E.queries()[name](spark, SF001))
    assert "Exchange" not in plan, plan
