"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Every query reads the given parquet tables (or the subscriber view Spark
derives from ``customer``) in full. Floating results that depend on
summation order or on ``exp``/``log`` are rounded to 6 decimals here (not in
the library functions) so the DuckDB oracle compares equal.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput import presets
from stayput.operators import boost, clean, decide, encode, evaluate, features, portfolio, score, split, train
from stayput.plans import training
from stayput.plans.feature_plan import FeaturePlan
from stayput.session import scratch, table_path
from stayput.sources import io, versions
from stayput.sources.subscribers import subscribers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------
def scored_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    """Subscriber view -> worked-example ensemble -> probability, prediction, y, tier, value at risk."""
    subs = subscribers(spark, sf)
    s = score.score_ensemble(subs, score.worked_example_trees(spark))
    s = s.withColumn("y", F.when(F.col("Departed") == "Yes", 1).otherwise(0))
    return decide.with_value_at_risk(s)


# ---------------------------------------------------------------------------
# M: scoring
# ---------------------------------------------------------------------------
@query("m3_ensemble_score")
def m3_ensemble_score(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID", r6("raw_score").alias("raw_score"),
                    r6("probability").alias("probability"), "prediction")


@query("m3_ensemble_score_large")
def m3_ensemble_score_large(spark, sf):
    """120 trees: 40 weighted copies of the worked example, scored by array traversal."""
    trees = score.weighted_copies(presets.WORKED_EXAMPLE_TREES, [(i % 5 + 1) / 64 for i in range(40)])
    return score.ensemble_score(_records(spark, sf), trees).select("customerID", r6("raw_score").alias("raw_score"))


@query("m5_decide_threshold")
def m5_decide_threshold(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID",
                    score.decide("probability", 0.5).alias("pred_050"),
                    score.decide("probability", 0.6).alias("pred_060"),
                    score.decide("probability", 0.5, strict=True).alias("pred_strict_050"))


# ---------------------------------------------------------------------------
# D: decisions
# ---------------------------------------------------------------------------
@query("d1_risk_tier")
def d1_risk_tier(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID", r6("probability").alias("probability"), "risk_tier",
                    decide.tier_label("risk_tier").alias("tier_label"))


@query("d2_clv_estimate")
def d2_clv_estimate(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID", "Contract", "tenure", "months_remaining", r6("clv").alias("clv"))


@query("d3_clv_at_risk")
def d3_clv_at_risk(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID", "attrition_probability", "clv_at_risk")


@query("d4_percent_probability")
def d4_percent_probability(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID", "attrition_probability")


@query("d9_stay_or_leave")
def d9_stay_or_leave(spark, sf):
    s = scored_subscribers(spark, sf)
    return s.select("customerID", decide.stay_or_leave("probability").alias("outcome"))


# ---------------------------------------------------------------------------
# A: portfolio
# ---------------------------------------------------------------------------
@query("a1_portfolio_kpi")
def a1_portfolio_kpi(spark, sf):
    k = portfolio.kpis(scored_subscribers(spark, sf))
    return k.select("customers", "predicted_attrition", r6("predicted_attrition_pct").alias("predicted_attrition_pct"),
                    "high_critical", "clv_at_risk_total")


@query("a2_tier_distribution")
def a2_tier_distribution(spark, sf):
    return portfolio.tier_distribution(scored_subscribers(spark, sf))


@query("a3_probability_histogram")
def a3_probability_histogram(spark, sf):
    h = portfolio.probability_histogram(scored_subscribers(spark, sf))
    return h.select("bin", r6("bin_start").alias("bin_start"), "customers")


@query("a4_top10")
def a4_top10(spark, sf):
    t = portfolio.top_risk(scored_subscribers(spark, sf), 10)
    return t.select("customerID", "attrition_probability", "risk_tier", "clv_at_risk", "Contract",
                    "tenure", r6("MonthlyCharges").alias("MonthlyCharges"))


@query("p9_high_risk_filter")
def p9_high_risk_filter(spark, sf):
    return portfolio.high_risk(scored_subscribers(spark, sf), 50.0).select("customerID", "attrition_probability")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf, name))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 inputs + target (no helper key)."""
    return subscribers(spark, sf).select(*presets.INPUT_COLUMNS, presets.TARGET)


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------------------
# P: projections, predicates
# ---------------------------------------------------------------------------
@query("p1_drop_target")
def p1_drop_target(spark, sf):
    return clean.drop_target(_records(spark, sf), presets.TARGET)


@query("p2_reorder_columns")
def p2_reorder_columns(spark, sf):
    return clean.reorder(_records(spark, sf), presets.IMPORTANCE_ORDER)


def _align_names():
    return presets.INPUT_COLUMNS + ["MonthlyCharges_is_na"] + presets.ENGINEERED_FEATURES[:3]


@query("p3_align_fill_zero")
def p3_align_fill_zero(spark, sf):
    return clean.align_features(features.add_tenure_group(_records(spark, sf)), _align_names(), fill=0)


@query("p4_align_fill_null")
def p4_align_fill_null(spark, sf):
    return clean.align_features(features.add_tenure_group(_records(spark, sf)), _align_names(), fill=None)


@query("p8_profile")
def p8_profile(spark, sf):
    return clean.profile(_records(spark, sf))


@query("p10_isin_predicate")
def p10_isin_predicate(spark, sf):
    s = _records(spark, sf)
    return s.where(F.col("InternetService").isin(*presets.INTERNET_VALUES)).select("customerID", "InternetService")


@query("p11_contains_predicate")
def p11_contains_predicate(spark, sf):
    o = _table(spark, sf, "orders")
    return o.select("o_orderkey", F.coalesce(F.col("o_orderpriority").contains("URGENT"), F.lit(False))
                    .cast("int").alias("is_urgent"))


@query("p12_rename_columns")
def p12_rename_columns(spark, sf):
    s = _records(spark, sf).select("customerID", "tenure", "Contract")
    return s.toDF("customer_id", "tenure_months", "contract_type")


@query("p13_preview")
def p13_preview(spark, sf):
    return _records(spark, sf).orderBy("customerID").limit(5)


# ---------------------------------------------------------------------------
# C: cleaning and imputation
# ---------------------------------------------------------------------------
@query("c1_dedupe_rows")
def c1_dedupe_rows(spark, sf):
    """C1 over whole rows: the distinct rows of a table that holds some rows twice."""
    e = _table(spark, sf, "events")
    return clean.dedupe(e.unionByName(e.where(F.col("user_id") % 3 == 0))).select("event_id", "user_id", "event_type")


@query("t3_kfold_null_label")
def t3_kfold_null_label(spark, sf):
    """Folds where the label is null for some rows: nulls are a class of their own."""
    o = _table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("label"))
    return split.assign_folds(o, "o_orderkey", "label").select("o_orderkey", "label", "fold")


@query("c1_dedupe")
def c1_dedupe(spark, sf):
    li = _table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    return clean.dedupe_report(li)


@query("c2_missing_flags")
def c2_missing_flags(spark, sf):
    s = _records(spark, sf)
    flags = clean.fit_missing_flags(s, ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"])
    return clean.add_missing_flags(s, flags).select("customerID", *[f"{c}_is_na" for c in flags])


@query("c3_median_impute")
def c3_median_impute(spark, sf):
    s = _records(spark, sf)
    num = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
    flags = clean.fit_missing_flags(s, num)
    out = clean.apply_impute(s, clean.fit_median(s, num), {}, widen=flags)
    return out.select("customerID", "tenure", r6("MonthlyCharges").alias("MonthlyCharges"),
                      r6("TotalCharges").alias("TotalCharges"))


@query("c3_median_table_lineitem")
def c3_median_table_lineitem(spark, sf):
    li = _table(spark, sf, "lineitem")
    return clean.median_table(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) \
        .select("column", r6("median").alias("median"))


@query("c4_mode_table")
def c4_mode_table(spark, sf):
    o = _table(spark, sf, "orders")
    return clean.mode_table(o, ["o_orderstatus", "o_orderpriority"]).select("column", "mode")


@query("c5_fill_zero")
def c5_fill_zero(spark, sf):
    s = clean.fill_zero(_records(spark, sf))
    return s.select("customerID", r6("MonthlyCharges").alias("MonthlyCharges"),
                    r6("TotalCharges").alias("TotalCharges"))


@query("c6_derive_total")
def c6_derive_total(spark, sf):
    s = clean.derive_total(_records(spark, sf))
    return s.select("customerID", r6("TotalCharges").alias("TotalCharges"))


# ---------------------------------------------------------------------------
# F: features
# ---------------------------------------------------------------------------
def _feature_query(name: str, fn):
    @query(name)
    def q(spark, sf):
        out = fn(_records(spark, sf))
        return _round_doubles(out.select("customerID", out.columns[-1]))
    return q


_feature_query("f1_tenure_group", features.add_tenure_group)
_feature_query("f2_tenure_to_max", features.add_tenure_to_max)
_feature_query("f3_tenure_monthly_ratio", features.add_tenure_monthly_ratio)
_feature_query("f4_charge_group", features.add_charge_group)
_feature_query("f5_total_services", features.add_total_services)
for _i, _name in enumerate(["has_internet", "has_phone", "is_month_to_month", "is_automatic_payment",
                            "is_senior", "has_dependents"]):
    _feature_query(f"f{6 + _i}_{_name}", lambda d, n=_name: features.add_named_indicator(d, n))
_feature_query("f12_attrition_risk_score", features.add_attrition_risk_score)
_feature_query("f14_avg_charge", features.add_avg_charge)
_feature_query("f15_charge_diff", lambda d: features.add_charge_diff(features.add_avg_charge(d)))
_feature_query("f17_total_count", lambda d: features.add_total_count(features.signed_encode(d)))


@query("f1_bins_lineitem")
def f1_bins_lineitem(spark, sf):
    li = _table(spark, sf, "lineitem")
    from stayput.functions.columns import bin_right_closed
    return li.select("l_orderkey", "l_linenumber",
                     bin_right_closed("l_quantity", [0, 10, 20, 30, 40, 50]).alias("quantity_bin"))


@query("f13_zscore")
def f13_zscore(spark, sf):
    s = _records(spark, sf)
    num = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
    imp = clean.apply_impute(s, clean.fit_median(s, num), {}, widen=clean.fit_missing_flags(s, num))
    out = features.apply_zscore(imp, features.fit_zscore(imp, num))
    return _round_doubles(out.select("customerID", *[c for c in out.columns if c.endswith("_zscore")]))


@query("f13_zscore_lineitem")
def f13_zscore_lineitem(spark, sf):
    li = _table(spark, sf, "lineitem")
    out = features.apply_zscore(li, features.fit_zscore(li, ["l_extendedprice", "l_quantity"]))
    return _round_doubles(out.select("l_orderkey", "l_linenumber", "l_extendedprice_zscore", "l_quantity_zscore"))


@query("f16_signed_encode")
def f16_signed_encode(spark, sf):
    s = features.signed_encode(_records(spark, sf))
    return s.select("customerID", *presets.SIGNED_MAPS.keys())


# ---------------------------------------------------------------------------
# E: encoding
# ---------------------------------------------------------------------------
SUB_CATEGORICAL = [c for c in presets.INPUT_COLUMNS if c not in
                   ("customerID", "SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges")]


@query("e1_label_fit")
def e1_label_fit(spark, sf):
    return encode.fit_labels(_records(spark, sf), SUB_CATEGORICAL)


def _lineitem_enc(spark, sf):
    li = _table(spark, sf, "lineitem")
    enc = encode.fit_labels(li.where(F.col("l_linestatus") == "F"), ["l_returnflag", "l_linestatus"])
    return li, enc


@query("e2_label_encode_unseen")
def e2_label_encode_unseen(spark, sf):
    li, enc = _lineitem_enc(spark, sf)
    out = encode.apply_labels(li, enc, ["l_returnflag", "l_linestatus"], unseen=0)
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query("e3_label_encode_keep_nulls")
def e3_label_encode_keep_nulls(spark, sf):
    s = _records(spark, sf)
    # a categorical column with gaps: the contract of customers without a monthly charge is unknown
    s = s.withColumn("Contract", F.when(F.col("MonthlyCharges").isNull(), F.lit(None)).otherwise(F.col("Contract")))
    enc = encode.fit_labels(s, ["Contract", "PaymentMethod", "gender"])
    out = encode.apply_labels(s.drop("gender"), enc, ["Contract", "PaymentMethod", "gender"],
                              keep_nulls=True, missing_as_null=True)
    return out.select("customerID", "Contract", "PaymentMethod", "gender")


@query("e4_unseen_values")
def e4_unseen_values(spark, sf):
    li, enc = _lineitem_enc(spark, sf)
    return encode.unseen_values(li, enc, ["l_returnflag", "l_linestatus"])


@query("e5_partition_encode")
def e5_partition_encode(spark, sf):
    li = _table(spark, sf, "lineitem")
    enc = encode.fit_labels(li, ["l_returnflag", "l_linestatus"])
    out = encode.apply_labels(li, enc, ["l_returnflag", "l_linestatus"])
    return out.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("e6_target_encode")
def e6_target_encode(spark, sf):
    coded, _ = encode.encode_target(_records(spark, sf), presets.TARGET, out="label")
    return coded.select("customerID", "label")


@query("e7_decode")
def e7_decode(spark, sf):
    s = scored_subscribers(spark, sf)
    enc = encode.fit_labels(s, [presets.TARGET])
    return encode.decode(s, enc, presets.TARGET, "prediction", "prediction_label") \
        .select("customerID", "prediction", "prediction_label")


@query("e8_fallback_target")
def e8_fallback_target(spark, sf):
    s = _records(spark, sf)
    return s.select("customerID", encode.fallback_target(presets.TARGET).alias("y"))


@query("e9_one_hot")
def e9_one_hot(spark, sf):
    s = _records(spark, sf)
    cols = ["Contract", "InternetService", "PaymentMethod"]
    out = encode.apply_one_hot(s, encode.fit_one_hot(s, cols))
    return out.select("customerID", *[c for c in out.columns if any(c.startswith(x + "_") for x in cols)])


@query("e11_feature_plan")
def e11_feature_plan(spark, sf):
    s = _records(spark, sf)
    plan = FeaturePlan(target=presets.TARGET, id_columns=["customerID"]).fit(s)
    return _round_doubles(plan.transform(s))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """subscribers -> FeaturePlan (impute, features) -> ensemble -> tiers, value at risk -> tier distribution."""
    s = _records(spark, sf)
    plan = FeaturePlan(target=presets.TARGET, id_columns=["customerID"]).fit(s)
    imputed = clean.apply_impute(s, plan.state.medians, plan.state.modes, widen=plan.state.missing_flags)
    scored = score.score_ensemble(features.engineer(imputed), score.worked_example_trees(spark))
    return portfolio.tier_distribution(decide.with_value_at_risk(scored))


# ---------------------------------------------------------------------------
# V: evaluation
# ---------------------------------------------------------------------------


def _ranked_subscribers(spark, sf):
    """Scored subscribers with the score rounded to 6 decimals (exact ties in both engines)."""
    return scored_subscribers(spark, sf).withColumn("score", F.round("probability", 6))


def _labels(spark, sf):
    lb = _table(spark, sf, "labels")
    return lb.select("doc_id", F.col("quality").alias("y"), (1 - F.col("toxic")).alias("yhat"))


@query("v1_accuracy")
def v1_accuracy(spark, sf):
    m = evaluate.binary_metrics(scored_subscribers(spark, sf), "y", "prediction")
    return m.select(r6("accuracy").alias("accuracy"))


@query("v2_f1")
def v2_f1(spark, sf):
    m = evaluate.binary_metrics(_labels(spark, sf), "y", "yhat")
    return m.select("tn", "fp", "fn", "tp", r6("f1").alias("f1"))


@query("v3_roc_auc")
def v3_roc_auc(spark, sf):
    m = evaluate.ranking_metrics(_ranked_subscribers(spark, sf), "y", "score")
    return m.select("n_pos", "n_neg", "distinct_scores", r6("roc_auc").alias("roc_auc"),
                    r6("average_precision").alias("average_precision"))


@query("v3_roc_auc_lineitem")
def v3_roc_auc_lineitem(spark, sf):
    li = _table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("score"))
    m = evaluate.ranking_metrics(li, "y", "score")
    return m.select("n_pos", "n_neg", "distinct_scores", r6("roc_auc").alias("roc_auc"),
                    r6("average_precision").alias("average_precision"))


@query("v3_roc_auc_lineitem_price")
def v3_roc_auc_lineitem_price(spark, sf):
    """V3 by a nearly distinct score."""
    li = _table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_extendedprice").alias("score"))
    m = evaluate.ranking_metrics(li, "y", "score", keep=True)
    return m.select("n_pos", "n_neg", "distinct_scores", r6("roc_auc").alias("roc_auc"), r6("average_precision").alias("average_precision"))


@query("v4_confusion_matrix")
def v4_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_labels(spark, sf), "y", "yhat")


@query("v5_classification_report")
def v5_classification_report(spark, sf):
    r = evaluate.classification_report(_labels(spark, sf), "y", "yhat")
    return _round_doubles(r)


@query("v6_roc_curve")
def v6_roc_curve(spark, sf):
    return _round_doubles(evaluate.roc_curve(_ranked_subscribers(spark, sf), "y", "score"))


@query("v7_pr_curve")
def v7_pr_curve(spark, sf):
    return _round_doubles(evaluate.pr_curve(_ranked_subscribers(spark, sf), "y", "score"))


@query("v8_average_precision")
def v8_average_precision(spark, sf):
    li = _table(spark, sf, "lineitem").select(
        "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10 + F.col("l_tax")).alias("score"))
    m = evaluate.ranking_metrics(li, "y", "score", by=["l_linestatus"], keep=True)
    return m.select("l_linestatus", "n_pos", "n_neg", r6("roc_auc").alias("roc_auc"),
                    r6("average_precision").alias("average_precision"))


@query("v9_log_loss")
def v9_log_loss(spark, sf):
    m = evaluate.training_monitors(scored_subscribers(spark, sf), "y", "probability", "prediction")
    return m.select(r6("log_loss").alias("log_loss"), r6("error_rate").alias("error_rate"))


@query("v10_confusion_type")
def v10_confusion_type(spark, sf):
    return evaluate.with_confusion_type(_labels(spark, sf), "y", "yhat").select("doc_id", "confusion_type")


@query("v11_confusion_type_counts")
def v11_confusion_type_counts(spark, sf):
    return evaluate.confusion_type_counts(_labels(spark, sf), "y", "yhat")


@query("v12_decoded_labels")
def v12_decoded_labels(spark, sf):
    out = evaluate.with_confusion_type(_labels(spark, sf), "y", "yhat", label_map={0: "No", 1: "Yes"})
    return out.select("doc_id", "y_true_label", "y_pred_label")


@query("v13_false_negatives")
def v13_false_negatives(spark, sf):
    s = scored_subscribers(spark, sf)
    out = evaluate.with_confusion_type(s, "y", "prediction")
    return out.where(F.col("confusion_type") == "FN").select("customerID", "Contract", "tenure", "PaymentMethod")


@query("v14_evaluation_bundle")
def v14_evaluation_bundle(spark, sf):
    s = split.stratified_split(_ranked_subscribers(spark, sf), "customerID", "y")
    out = evaluate.evaluation(s, "y", "prediction", "score", by=["split"])
    return out.select("split", "tn", "fp", "fn", "tp", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"),
                      r6("roc_auc").alias("roc_auc"), r6("average_precision").alias("average_precision"))


# ---------------------------------------------------------------------------
# T: splits, folds, class balance
# ---------------------------------------------------------------------------
@query("t1_stratified_split")
def t1_stratified_split(spark, sf):
    s = split.stratified_split(_records(spark, sf), "customerID", presets.TARGET)
    return s.select("customerID", "Departed", "split")


@query("t1_stratified_split_orders")
def t1_stratified_split_orders(spark, sf):
    o = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(o, "o_orderkey", "o_orderstatus")


@query("t2_stratified_split_alt")
def t2_stratified_split_alt(spark, sf):
    o = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    s = split.stratified_split(o, "o_orderkey", "o_orderstatus", presets.SPLIT_FRACTIONS_ALT)
    return s.groupBy("o_orderstatus", "split").agg(F.count(F.lit(1)).alias("n"))


@query("t3_kfold")
def t3_kfold(spark, sf):
    o = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.assign_folds(o, "o_orderkey", "o_orderstatus", k=5)


@query("t4_class_distribution")
def t4_class_distribution(spark, sf):
    return split.class_distribution(_table(spark, sf, "orders"), "o_orderstatus")


@query("t5_pos_weight")
def t5_pos_weight(spark, sf):
    return split.pos_weight(scored_subscribers(spark, sf), "y")


# ---------------------------------------------------------------------------
# Reasons, actions, what-if
# ---------------------------------------------------------------------------
def _worked_example_scorer(spark):
    trees = score.worked_example_trees(spark)

    def scorer(df: DataFrame) -> DataFrame:
        return score.with_probability(score.ensemble_score(df, trees)).drop("raw_score")
    return scorer


@query("d5_risk_drivers")
def d5_risk_drivers(spark, sf):
    return decide.risk_drivers(_records(spark, sf))


@query("d6_retention_playbook")
def d6_retention_playbook(spark, sf):
    return decide.retention_playbook(scored_subscribers(spark, sf)).select("customerID", "position", "title", "detail", "priority")


@query("d7_scenario_impact")
def d7_scenario_impact(spark, sf):
    imp = decide.scenario_impact(_records(spark, sf), _worked_example_scorer(spark))
    return imp.select("customerID", "action", r6("base_probability").alias("base_probability"),
                      r6("new_probability").alias("new_probability"), r6("delta").alias("delta"),
                      "attrition_probability_pct", "reduction_pp")


@query("d8_best_action")
def d8_best_action(spark, sf):
    best = decide.best_action_in_row(_records(spark, sf), score.worked_example_trees(spark))
    return best.select("customerID", "action", r6("new_probability").alias("new_probability"),
                       "attrition_probability_pct", "reduction_pp")


@query("d10_impact_text")
def d10_impact_text(spark, sf):
    imp = decide.scenario_impact(_records(spark, sf), _worked_example_scorer(spark))
    label, text = decide.impact_text("action", "base_probability", "attrition_probability_pct", "reduction_pp")
    return imp.select("customerID", "action", label.alias("label"), text.alias("text"))


# ---------------------------------------------------------------------------
# T6-T12, M1, S: training, model scoring, sources and sinks (rows-only checks)
# ---------------------------------------------------------------------------

_TRAINED: dict = {}


def searched(spark: SparkSession, sf: str):
    """Two small candidates on all five folds, per (session, scale); ``training.fit``'s own defaults are the full search."""
    key = ("search", spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = training.search(_records(spark, sf), space=training.SMALL_SEARCH, n_candidates=2)
    return _TRAINED[key]


#: The final fit of the shared model, from the full search space.
FINAL = {"n_estimators": 500, "max_depth": 5, "learning_rate": 0.1}


def trained(spark: SparkSession, sf: str):
    """One trained model per (session, scale), shared by the training queries: rounds and patience of the full flow."""
    key = ("model", spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = training.finish(searched(spark, sf), final=FINAL)
    return _TRAINED[key]


def _fit_log(spark, sf):
    found = searched(spark, sf)
    if found.cv_model is None:
        raise RuntimeError("the search failed; the final model used the fallback parameters")
    return train.fit_log(spark, found.cv_model, found.candidates)


@query("t6_random_search")
def t6_random_search(spark, sf):
    return _fit_log(spark, sf).select("candidate", "total", "folds", "score", "score_std", "params")


@query("t7_train_boosted")
def t7_train_boosted(spark, sf):
    tm = trained(spark, sf)
    test = tm.data.where(F.col("split") == "test")
    return score.score_model(test, tm.model, labels=["No", "Yes"]).select("customerID", "probability", "prediction")


@query("t8_cv_auc")
def t8_cv_auc(spark, sf):
    tm = trained(spark, sf)
    trn = split.assign_folds(tm.data.where(F.col("split") == "train"), "customerID", "label")
    params = {**tm.params, "n_estimators": max(tm.model.best_round, 1)}     # as many rounds as the model keeps
    return train.cv_summary(train.cv_auc(trn, params, tm.plan.state.feature_names, ratio=train.class_ratio(trn), key=["customerID"]))


#: Bounds of the split-gain queries' bins, so that SQL can cut the same bins.
GAIN_EDGES = {"tenure": list(range(3, 73, 3)), "MonthlyCharges": list(range(20, 121, 5)), "TotalCharges": list(range(250, 8001, 250)),
              "SeniorCitizen": [1]}
GAIN_SETTING = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.3, "reg_alpha": 0.5, "reg_lambda": 1.5, "min_child_weight": 2}


def _gain_rows(spark, sf):
    s = subscribers(spark, sf)
    return s.select("customerID", *GAIN_EDGES, (F.col(presets.TARGET) == "Yes").cast("int").alias("label"))


@query("t7_split_gains")
def t7_split_gains(spark, sf):
    """The regularised gain of every allowed root split of four numeric features with nulls, nulls sent right and left."""
    rows, names = _gain_rows(spark, sf), list(GAIN_EDGES)
    edges = [np.array(GAIN_EDGES[c], float) for c in names]
    gains = boost.root_gains(rows, names, edges, boost.Setting.of(GAIN_SETTING))
    return gains.select("feature", "threshold", "nulls_left", F.round("gain", 4).alias("gain"), "n_left", "n_right")


@query("m1_one_round_predict")
def m1_one_round_predict(spark, sf):
    """M1: a one-round ensemble is fitted, written as a tree table, read back and applied."""
    rows, names = _gain_rows(spark, sf), list(GAIN_EDGES)
    model = boost.fit(rows, names, GAIN_SETTING, key=["customerID"], edges=[np.array(GAIN_EDGES[c], float) for c in names])
    path = f"{scratch(spark, 'trees')}/model"
    boost.model_table(spark, model).write.parquet(path)
    out = score.score_ensemble(rows, spark.read.parquet(path))
    return out.select("customerID", r6("probability").alias("probability"), "prediction")


@query("t10_importance")
def t10_importance(spark, sf):
    tm = trained(spark, sf)
    return train.importance(spark, tm.model, tm.plan.state.feature_names, 10)


@query("t11_early_stop")
def t11_early_stop(spark, sf):
    tm = trained(spark, sf)
    return train.early_stop_info(spark, tm.model, int(tm.params["n_estimators"]))


@query("t12_training_summary")
def t12_training_summary(spark, sf):
    tm = trained(spark, sf)
    ev = training.evaluate_splits(tm).where(F.col("split") == "test").first()
    return train.training_summary(spark, {
        "params": tm.params, "features": len(tm.plan.state.feature_names),
        "test_auc": round(ev["roc_auc"], 6), "test_accuracy": round(ev["accuracy"], 6),
        "trees": tm.model.best_round})


@query("m1_batch_predict")
def m1_batch_predict(spark, sf):
    tm = trained(spark, sf)
    return training.predict(tm, _records(spark, sf)).select("customerID", "probability", "prediction")


@query("v14_evaluation_trained")
def v14_evaluation_trained(spark, sf):
    return training.evaluate_splits(trained(spark, sf))


@query("s1_csv_roundtrip")
def s1_csv_roundtrip(spark, sf):
    path = f"{scratch(spark, 'csv')}/subscribers"
    io.write_table(_records(spark, sf), path, "csv")
    return io.read_customers(spark, path)


@query("s5_state_equal")
def s5_state_equal(spark, sf):
    """Customers whose prediction changes when plan and model are saved as a version and loaded again."""
    tm = trained(spark, sf)
    root = scratch(spark, "versions")
    versions.save(spark, root, tm.plan, tm.model, tm.labels)
    again = training.predict(versions.load(spark, root), _records(spark, sf)).select("customerID", F.col("probability").alias("p"), F.col("prediction").alias("q"))
    both = training.predict(tm, _records(spark, sf)).join(again, "customerID")
    off = (F.abs(F.col("probability") - F.col("p")) > 1e-9) | (F.col("prediction") != F.col("q"))
    return both.agg(F.count(F.lit(1)).alias("customers"), F.count_if(off).alias("differing"))


@query("s5_state_roundtrip")
def s5_state_roundtrip(spark, sf):
    tm = trained(spark, sf)
    root = scratch(spark, "state")
    versions.save(spark, root, tm.plan, tm.model, tm.labels)
    return training.predict(versions.load(spark, root), _records(spark, sf)).select("customerID", "probability", "prediction")


def subscriber_records_json(spark, sf) -> DataFrame:
    """One JSON subscriber record per active user in ``events`` (user_id = customer key)."""
    users = _table(spark, sf, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    subs = subscribers(spark, sf)
    rec_cols = [f.name for f in io.RECORD_SCHEMA.fields]
    return subs.join(users, "c_custkey", "left_semi") \
        .select("customerID", F.to_json(F.struct("customerID", *rec_cols)).alias("value"))


@query("s7_parse_records")
def s7_parse_records(spark, sf):
    """Records of the customers that occur in ``events``; that choice is the feature."""
    ok, _bad = io.parse_records(subscriber_records_json(spark, sf), keep=("customerID",))
    return ok


@query("r1_stream_scoring")
def r1_stream_scoring(spark, sf):
    """Records of active users -> JSON files -> streaming scorer -> parquet sink (read back)."""
    from stayput.streaming.scoring import score_stream
    run = scratch(spark, "stream")
    subscriber_records_json(spark, sf).select("value").write.mode("overwrite").text(f"{run}/in")
    trees = score.worked_example_trees(spark)

    def scorer(df):
        return score.score_ensemble(df, trees)
    q_ = score_stream(spark, f"{run}/in", scorer, f"{run}/out", f"{run}/ckpt", f"{run}/rejects")
    q_.awaitTermination()
    out = spark.read.parquet(f"{run}/out")
    return out.select("customerID", r6("probability").alias("probability"), "prediction", "risk_tier",
                      "attrition_probability", "clv_at_risk")


@query("r1_stream_newest_model")
def r1_stream_newest_model(spark, sf):
    """R1 with a trained model: records of active users are imputed, encoded and scored by the newest saved version; how many
    were scored, and how many of them other than the batch path scores them."""
    from stayput.streaming.scoring import newest_scorer, score_stream
    tm = trained(spark, sf)
    run = scratch(spark, "stream")
    versions.save(spark, f"{run}/models", tm.plan, tm.model, tm.labels)
    subscriber_records_json(spark, sf).select("value").write.text(f"{run}/in")
    score_stream(spark, f"{run}/in", newest_scorer(spark, f"{run}/models"), f"{run}/out", f"{run}/ckpt").awaitTermination()
    out = spark.read.parquet(f"{run}/out").select("customerID", F.col("probability").alias("p"))
    both = out.join(training.model_scorer(tm)(_records(spark, sf)).select("customerID", "probability"), "customerID", "left")
    off = F.coalesce(F.abs(F.col("p") - F.col("probability")) > 1e-9, F.lit(True))
    return both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(off).alias("differing"))


@query("a5_batch_report")
def a5_batch_report(spark, sf):
    """A5 composite: the scored table the report writes (KPIs, tiers, histogram, top 10 read from it)."""
    from stayput.plans.batch_report import batch_report
    rep = batch_report(scored_subscribers(spark, sf))
    return rep["scored"].select("customerID", r6("probability").alias("probability"), "prediction",
                                "attrition_probability", "risk_tier", "months_remaining", "clv_at_risk")


# ---------------------------------------------------------------------------
# further inventory rows: M4, M6, E3 composite (null-keeping plan), F17 train variant, S2, S4, E10
# ---------------------------------------------------------------------------
@query("m4_sigmoid")
def m4_sigmoid(spark, sf):
    s = score.ensemble_score(_records(spark, sf), score.worked_example_trees(spark))
    return score.with_probability(s, "raw_score", "p").select("customerID", r6("p").alias("p"))


@query("m6_append_predictions")
def m6_append_predictions(spark, sf):
    """Input columns kept, predictions appended (no join back)."""
    s = scored_subscribers(spark, sf)
    return s.select(*presets.INPUT_COLUMNS, presets.TARGET, r6("probability").alias("probability"),
                    "prediction", "attrition_probability", "risk_tier")


@query("e11_feature_plan_keep_nulls")
def e11_feature_plan_keep_nulls(spark, sf):
    """Null-keeping variant: label codes only, nulls stay null."""
    s = _records(spark, sf)
    plan = FeaturePlan(target=presets.TARGET, id_columns=["customerID"], keep_nulls=True).fit(s)
    return _round_doubles(plan.transform(s))


@query("f17_total_count_train")
def f17_total_count_train(spark, sf):
    s = features.add_total_count(features.signed_encode(_records(spark, sf)), presets.SIGNED_COUNT_TRAIN)
    return s.select("customerID", "total_count")


@query("s2_csv_sink_scored")
def s2_csv_sink_scored(spark, sf):
    """The scored table written as header CSV, read back with its schema."""
    from stayput.plans.batch_report import batch_report
    path = f"{scratch(spark, 'csv')}/scored"
    scored = scored_subscribers(spark, sf).select("customerID", "Contract", "tenure", "MonthlyCharges",
                                                   r6("probability").alias("probability"), "attrition_probability",
                                                   "risk_tier", "clv_at_risk")
    batch_report(scored, sink=path)
    return spark.read.schema(scored.schema).option("header", True).csv(path)


@query("s6_latest_version")
def s6_latest_version(spark, sf):
    """The latest entry of a registry that holds one version per event."""
    reg = _table(spark, sf, "events").select(F.concat(F.lit("model-"), F.col("event_id").cast("string")).alias("path"),
                                             F.col("event_id").alias("saved_at"))
    return io.latest_version(reg)


@query("s4_metrics_json")
def s4_metrics_json(spark, sf):
    """The classification report written as JSON lines and read back."""
    path = f"{scratch(spark, 'metrics')}/report"
    rep = evaluate.classification_report(_labels(spark, sf), "y", "yhat")
    io.write_metrics(rep, path)
    return spark.read.schema(rep.schema).json(path)


@query("e10_assemble_vector")
def e10_assemble_vector(spark, sf):
    """The ordered feature vector, read back one column per place."""
    from pyspark.ml.functions import vector_to_array
    s = _records(spark, sf)
    plan = FeaturePlan(target=presets.TARGET, id_columns=["customerID"]).fit(s)
    names = plan.state.feature_names
    v = encode.assemble(plan.transform(s), names).select("customerID", vector_to_array("features").alias("x"))
    return v.select("customerID", *[r6(F.col("x")[i]).alias(c) for i, c in enumerate(names)])


@query("d7_scenario_impact_trained")
def d7_scenario_impact_trained(spark, sf):
    """What-if impact with the trained MLlib model as scorer (rows-only check)."""
    tm = trained(spark, sf)
    imp = decide.scenario_impact(_records(spark, sf), training.model_scorer(tm))
    return imp.select("customerID", "action", "new_probability", "delta", "attrition_probability_pct", "reduction_pp")


@query("a5_report_sections")
def a5_report_sections(spark, sf):
    """A5: KPIs, tiers, histogram and top customers of the report, counted while the scored table is written."""
    from stayput.plans.batch_report import batch_report, sections
    return sections(batch_report(scored_subscribers(spark, sf))).withColumn("value", r6("value"))


@query("a5_batch_report_trained")
def a5_batch_report_trained(spark, sf):
    """A5 with the trained model: score all subscribers, then all summaries (rows-only check)."""
    from stayput.plans.batch_report import batch_report, sections
    tm = trained(spark, sf)
    return sections(batch_report(decide.with_value_at_risk(training.model_scorer(tm)(_records(spark, sf)))))


@query("t9_fit_log")
def t9_fit_log(spark, sf):
    """One row per candidate (folds counted separately) with a timestamp (rows-only check)."""
    return _fit_log(spark, sf)


@query("s3_fit_log_append")
def s3_fit_log_append(spark, sf):
    """S3: fit-log rows appended as JSON lines (twice), read back (rows-only check)."""
    path = f"{scratch(spark, 'fits')}/log"
    log = t9_fit_log(spark, sf).drop("ts")
    io.append_fits(log, path)
    io.append_fits(log, path)
    return spark.read.schema(log.schema).json(path)


@query("s3_fit_log_counts")
def s3_fit_log_counts(spark, sf):
    """Per candidate of the twice appended log, its folds, the candidates of the search, its lines and those with a score."""
    log = s3_fit_log_append(spark, sf)
    return log.groupBy("candidate").agg(F.max("total").alias("total"), F.max("folds").alias("folds"), F.count(F.lit(1)).alias("lines"),
                                        F.count_if(F.col("score").between(0, 1)).alias("scored"))


@query("v6_roc_curve_lineitem")
def v6_roc_curve_lineitem(spark, sf):
    """ROC curve over lineitem with a nearly distinct score (many thresholds)."""
    li = _table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_extendedprice").alias("score"))
    return _round_doubles(evaluate.roc_curve(li, "y", "score", keep=True))
