"""Edge rows of the fixed rules (bins, tiers, months, encoder, imputation, z-score, confusion type)."""


import pytest
from pyspark.sql import functions as F

from stayput import presets
from stayput.functions.columns import bin_right_closed
from stayput.operators import clean, decide, encode, evaluate, features


def test_tenure_bins(spark):
    vals = [None, -1, 0, 1, 12, 13, 24, 60, 72, 73]
    df = spark.createDataFrame([(v,) for v in vals], "t int")
    got = [r[0] for r in df.select(bin_right_closed("t", presets.TENURE_EDGES)).collect()]
    assert got == [-1, -1, -1, 0, 0, 1, 1, 4, 5, -1]


def test_charge_bins(spark):
    vals = [None, 0.0, 0.01, 30.0, 30.01, 60.0, 90.0, 120.0, 120.01]
    df = spark.createDataFrame([(v,) for v in vals], "m double")
    got = [r[0] for r in df.select(bin_right_closed("m", presets.CHARGE_EDGES)).collect()]
    assert got == [-1, -1, 0, 0, 1, 1, 2, 3, -1]


def test_tiers_and_outreach(spark):
    ps = [0.2999, 0.30, 0.4999, 0.50, 0.6999, 0.70, 0.7001]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    tiers = [r[0] for r in df.select(decide.risk_tier("p")).collect()]
    assert tiers == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]
    pb = df.withColumn("Contract", F.lit("Two year")).withColumn("PaymentMethod", F.lit("Credit card (automatic)")) \
        .withColumn("InternetService", F.lit("No")).withColumn("TechSupport", F.lit("No internet service")) \
        .withColumn("OnlineSecurity", F.lit("No internet service")).withColumn("tenure", F.lit(40)) \
        .select("p", decide.playbook_array(p="p").alias("a")).collect()
    titles = {r["p"]: [a["title"] for a in r["a"]] for r in pb}
    assert titles[0.70] == ["Monitor & Maintain"]          # CRITICAL tier, but outreach only above 0.70
    assert titles[0.7001][0].startswith("Proactive Outreach")


def test_months_remaining(spark):
    rows = [("Two year", 0), ("Two year", 23), ("Two year", 24), ("One year", 0), ("One year", 11),
            ("One year", 12), ("Month-to-month", 5)]
    df = spark.createDataFrame(rows, "c string, t int")
    got = [r[0] for r in df.select(decide.months_remaining("c", "t")).collect()]
    assert got == [24, 6, 24, 12, 3, 12, 6]


def test_encoder_unseen_and_nulls(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    enc = encode.fit_labels(train, ["x"])
    assert sorted((r["value"], r["code"]) for r in enc.collect()) == [("a", 0), ("b", 1), ("c", 2)]
    test = spark.createDataFrame([("c",), ("z",), (None,)], "x string")
    assert [r[0] for r in encode.apply_labels(test, enc, ["x"]).collect()] == [2, 0, 0]
    assert [r[0] for r in encode.apply_labels(test, enc, ["x"], keep_nulls=True).collect()] == [2, 0, None]


def test_imputation_rules(spark):
    df = spark.createDataFrame([(1.0, "b", None), (2.0, "a", None), (3.0, "b", None), (10.0, "a", None),
                                (None, None, None)], "n double, s string, e string")
    assert clean.fit_median(df, ["n"]) == {"n": 2.5}          # even count -> midpoint
    assert clean.fit_mode(df, ["s", "e"]) == {"s": "a", "e": "Unknown"}   # tie -> smallest; all null
    # the distributed path (many buckets) gives the same answer
    assert clean.fit_median(df, ["n"], rows_per_bucket=1) == {"n": 2.5}


def test_zscore_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    out = features.apply_zscore(df, features.fit_zscore(df, ["a", "c"]))
    assert "a_zscore" in out.columns and "c_zscore" not in out.columns
    assert [round(r[0], 6) for r in out.select("a_zscore").collect()] == [-1.0, 0.0, 1.0]


def test_confusion_type(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (0, 1), (1, 0), (None, 1)], "y int, p int")
    got = [r[0] for r in df.select(evaluate.confusion_type("y", "p")).collect()]
    assert got == ["TP", "TN", "FP", "FN", "Unknown"]


def test_scenarios_empty_keeps_schema(spark):
    df = spark.createDataFrame([("c1", 0.1)], "customerID string, MonthlyCharges double")
    for c in presets.SCENARIO_COLUMNS:
        df = df.withColumn(c, F.lit("Yes"))

    def flat(d):  # a scorer that ignores the overrides
        return d.withColumn("probability", F.lit(0.2))
    imp = decide.scenario_impact(df, flat)
    assert imp.count() == 0
    assert {"customerID", "action", "delta", "reduction_pp"} <= set(imp.columns)


def test_label_codes_distributed_equal_single(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    cols = ["o_orderpriority", "o_orderstatus", "o_custkey"]
    one = {(r[0], r[1]): r[2] for r in encode.fit_labels(li, cols).collect()}
    many = {(r[0], r[1]): r[2] for r in encode.fit_labels(li, cols, rows_per_part=97).collect()}
    assert one == many and len(one) > 1000
    # codes follow the sorted string order within each column
    pri = sorted((v, c) for (col, v), c in one.items() if col == "o_orderpriority")
    assert [c for _, c in pri] == list(range(len(pri)))


def test_large_dictionary_join_path(spark, monkeypatch):
    """Dictionaries above the literal-map limit are applied by a join with the same result."""
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("cust"))
    enc = encode.fit_labels(o, ["cust"])
    small = {r[0]: r[1] for r in encode.apply_labels(o, enc, ["cust"]).collect()}
    monkeypatch.setattr(encode, "MAP_LITERAL_MAX", 10)
    big = {r[0]: r[1] for r in encode.apply_labels(o, enc, ["cust"]).collect()}
    assert small == big


def test_scenarios_valid_only(spark):
    rows = [("c1", "No", "No internet service", "No internet service", "No internet service",
             "Month-to-month", "Electronic check", 50.0, "No", 3)]
    df = spark.createDataFrame(rows, "customerID string, InternetService string, TechSupport string, "
                                     "OnlineSecurity string, OnlineBackup string, Contract string, "
                                     "PaymentMethod string, MonthlyCharges double, PaperlessBilling string, tenure int")
    all_rows = decide.apply_scenarios(df).select("action").collect()
    valid = decide.apply_scenarios(df, valid_only=True).select("action").collect()
    assert len(all_rows) == 8 and len(valid) == 5
    assert not {"Add Tech Support", "Add Online Security", "Add Online Backup"} & {r[0] for r in valid}


def test_best_action_tie_goes_to_earlier_scenario(spark):
    rows = [("c1", "A", 1, 0.5, 0.4, 0.1, 40.0, 10.0), ("c1", "B", 0, 0.5, 0.4, 0.1, 40.0, 10.0),
            ("c2", "A", 0, 0.5, 0.45, 0.05, 45.0, 5.0), ("c2", "B", 1, 0.5, 0.3, 0.2, 30.0, 20.0)]
    imp = spark.createDataFrame(rows, "customerID string, action string, action_rank int, base_probability double, "
                                      "new_probability double, delta double, attrition_probability_pct double, "
                                      "reduction_pp double")
    best = {r["customerID"]: r["action"] for r in decide.best_action(imp).collect()}
    assert best == {"c1": "B", "c2": "B"}


def test_feature_plan_all_null_category(spark):
    from stayput.plans.feature_plan import FeaturePlan
    df = spark.createDataFrame([("a", None, 1.0, "Yes"), ("b", None, None, "No"), ("c", None, 3.0, "No")],
                               "customerID string, s string, x double, Departed string")
    plan = FeaturePlan(target="Departed", id_columns=["customerID"]).fit(df)
    assert plan.state.modes == {"s": "Unknown"}
    assert sorted((r["value"], r["code"]) for r in plan.state.encoders.collect()) == [("Unknown", 0)]
    out = plan.transform(df).orderBy("customerID").collect()
    assert [r["s"] for r in out] == [0, 0, 0]
    assert [r["x"] for r in out] == [1.0, 2.0, 3.0] and [r["x_is_na"] for r in out] == [0, 1, 0]


def test_param_mapping():
    from stayput.operators import train
    m = train.gbt_params({"n_estimators": 200, "max_depth": -1, "learning_rate": 0.05, "subsample": 0.8,
                          "colsample_bytree": 0.7, "min_child_samples": 20, "num_leaves": 31})
    assert m == {"maxIter": 200, "maxDepth": 30, "stepSize": 0.05, "subsamplingRate": 0.8,
                 "featureSubsetStrategy": "0.7", "minInstancesPerNode": 20}
    cands = train.sample_candidates(presets.SEARCH_SPACE_LEAFWISE, presets.SEARCH_CANDIDATES_LEAFWISE)
    assert len(cands) == 20 and cands == train.sample_candidates(presets.SEARCH_SPACE_LEAFWISE, 20)


def test_nan_takes_no_branch_on_both_sides_of_the_switch(spark):
    from stayput.operators import score

    df = spark.createDataFrame([(0.0, 1), (2.0, 1), (float("nan"), 1), (None, 1)], "x double, y int")
    for op in (">", ">=", "<", "<=", "=", "!="):
        tree = [(0, 0, "x", op, "1.0", 1, 2, None), (0, 1, "y", ">", "0", 3, 2, None), (0, 2, None, None, None, None, None, 0.0),
                (0, 3, None, None, None, None, None, 1.0)]
        got = [[r.raw_score / n for r in score.ensemble_score(df, score.weighted_copies(tree, [1.0] * n)).collect()] for n in (1, score.TREES_COMPILED + 1)]
        assert got[0] == got[1] and got[0][2:] == [0.0, 0.0], op


def test_deep_trees_are_walked_and_circles_found(spark):
    from stayput.operators import score

    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    deep = [(0, 2 * k, "x", ">", str(k), 2 * k + 2, 2 * k + 1, None) for k in range(90)] + [(0, 2 * k + 1, None, None, None, None, None, float(k)) for k in range(90)]
    deep.append((0, 180, None, None, None, None, None, 90.0))
    assert [r.raw_score for r in score.ensemble_score(df, deep).collect()] == [min(max(float(i), 0.0), 90.0) for i in range(100)]
    with pytest.raises(ValueError):
        score.ensemble_score(df, [(0, 0, "x", ">", "1", 0, 1, None), (0, 1, None, None, None, None, None, 0.0)])


def test_best_action_in_row_equals_the_exploded_form(spark):
    from stayput import catalog
    from stayput.operators import decide, score
    from tests.conftest import SF01

    raw, trees = catalog._records(spark, SF01), score.worked_example_trees(spark)
    wide = decide.best_action_in_row(raw, trees)
    long = decide.best_action(decide.scenario_impact(raw, lambda d: score.score_ensemble(d, trees)))
    key = ["customerID", "action", "attrition_probability_pct", "reduction_pp"]
    a, b = (x.select(*key, *[F.round(c, 9).alias(c) for c in ("base_probability", "new_probability", "delta")]) for x in (wide, long))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_profile_moments_equal_those_of_imputed_rows(spark):
    from stayput.operators import clean, features

    df = spark.createDataFrame([(1, 2.5, None), (None, float("nan"), None), (4, 1e9, None), (7, None, None), (9, 3.0, None)], "a int, b double, c double")
    cols = ["a", "b", "c"]
    profile = clean.numeric_profile(df, cols)
    medians = clean.fit_median(df, cols, profile=profile)
    assert medians == clean.fit_median(df, cols) == {"a": 5.5, "b": 3.0, "c": None}
    want = features.fit_zscore(clean.apply_impute(df, medians, {}, widen=cols), ["a", "b"])
    got = clean.imputed_moments(profile, medians)
    for c in ("a", "b"):
        assert abs(got[c]["mean"] - want[c]["mean"]) <= 1e-9 * abs(want[c]["mean"]) and abs(got[c]["std"] - want[c]["std"]) <= 1e-9 * want[c]["std"]
    assert got["c"] == {"mean": None, "std": None}
