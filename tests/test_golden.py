"""Golden values: the worked 3-row example, the recorded confusion report, fixture AUCs."""

from pyspark.sql import functions as F

from stayput.operators import evaluate, score
from stayput.operators.evaluate import ranking_metrics
from tests.conftest import SF01


def test_worked_example(spark):
    rows = [(24.6, "No", 1, "Electronic check"), (24.2, "No", 1, "Mailed check"),
            (43.95, "Yes", 1, "Electronic check")]
    df = spark.createDataFrame(rows, "MonthlyCharges double, PaperlessBilling string, tenure int, PaymentMethod string")
    out = score.score_ensemble(df, score.as_table(spark, score.worked_example_trees())).collect()
    assert [round(r["raw_score"], 6) for r in out] == [0.4, -0.2, 1.9]
    assert [round(r["probability"], 4) for r in out] == [0.5987, 0.4502, 0.8699]
    assert [r["prediction"] for r in out] == [1, 0, 1]


def test_null_takes_no_branch(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "MonthlyCharges double, PaperlessBilling string, tenure int, PaymentMethod string")
    r = score.ensemble_score(df, score.worked_example_trees(spark)).first()
    assert round(r["raw_score"], 6) == round(-0.2 + 0.1 - 0.1, 6)


def test_recorded_report(spark):
    rows = [(0, 0)] * 783 + [(0, 1)] * 252 + [(1, 0)] * 75 + [(1, 1)] * 299
    df = spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(rows)], "id long, y int, yhat int")
    rep = {r["class"]: r for r in evaluate.classification_report(df, "y", "yhat").collect()}
    assert round(rep["0"]["precision"], 6) == 0.912587 and round(rep["0"]["recall"], 6) == 0.756522
    assert round(rep["1"]["precision"], 6) == 0.542650 and round(rep["1"]["f1_score"], 6) == 0.646486
    assert round(rep["accuracy"]["f1_score"], 6) == 0.767921
    assert round(rep["macro avg"]["f1_score"], 6) == 0.736872
    assert round(rep["weighted avg"]["precision"], 6) == 0.814392
    assert rep["weighted avg"]["support"] == 1409


def test_fixture_auc_and_tiers(spark):
    from stayput.catalog import scored_subscribers
    s = scored_subscribers(spark, SF01).withColumn("score", F.round("probability", 6))
    m = ranking_metrics(s, "y", "score").first()
    assert round(m["roc_auc"], 6) == 0.638202
    assert round(m["average_precision"], 6) == 0.432823
    assert m["distinct_scores"] == 11
    cm = evaluate.confusion_counts(s, "y", "prediction").first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (119, 918, 26, 437)
    tiers = {r["risk_tier"]: r["n"] for r in s.groupBy("risk_tier").agg(F.count("*").alias("n")).collect()}
    assert tiers == {"MEDIUM": 145, "HIGH": 969, "CRITICAL": 386}


def test_bucketed_equals_single_bucket(spark):
    """The multi-bucket running totals give exactly the single-partition answer."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_extendedprice") / 1000).alias("score"))
    one = ranking_metrics(li, "y", "score").first()
    many = ranking_metrics(li, "y", "score", rows_per_bucket=500).first()
    assert one["roc_auc"] == many["roc_auc"]
    assert abs(one["average_precision"] - many["average_precision"]) < 1e-12
    c1 = evaluate.roc_curve(li, "y", "score").count()
    c2 = evaluate.roc_curve(li, "y", "score", rows_per_bucket=500).count()
    assert c1 == c2


def test_many_trees_chunked(spark):
    """A 60-tree generated ensemble (chunked sums) equals a plain Python walk of the trees."""
    import random
    rng = random.Random(3)
    feats = [("MonthlyCharges", "num"), ("tenure", "num"), ("Contract", "cat")]
    trees = []
    for t in range(60):
        def grow(node, depth, nxt):
            if depth == 3 or rng.random() < 0.2:
                trees.append((t, node, None, None, None, None, None, round(rng.uniform(-1, 1), 3)))
                return nxt
            f, kind = rng.choice(feats)
            if kind == "num":
                op, th = rng.choice([">", "<", ">=", "<="]), str(rng.randint(5, 90))
            else:
                op, th = "=", rng.choice(["Month-to-month", "One year", "Two year"])
            yes, no = nxt, nxt + 1
            trees.append((t, node, f, op, th, yes, no, None))
            nxt = grow(yes, depth + 1, nxt + 2)
            return grow(no, depth + 1, nxt)
        grow(0, 0, 1)
    tdf = spark.createDataFrame(trees, score.TREE_SCHEMA)
    rows = [(float(rng.randint(0, 120)), rng.randint(0, 72), rng.choice(["Month-to-month", "One year", "Two year"]))
            for _ in range(50)]
    df = spark.createDataFrame(rows, "MonthlyCharges double, tenure int, Contract string")
    got = [r["raw_score"] for r in score.ensemble_score(df, tdf).collect()]
    nodes = {(t, n): (f, op, th, y, no, leaf) for t, n, f, op, th, y, no, leaf in trees}
    ops = {">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b,
           "<=": lambda a, b: a <= b, "=": lambda a, b: a == b}

    def walk(t, row):
        n = 0
        while True:
            f, op, th, y, no, leaf = nodes[(t, n)]
            if f is None:
                return leaf
            v = row[f]
            n = y if ops[op](v, float(th) if op != "=" else th) else no
    for (mc, ten, c), g in zip(rows, got):
        row = {"MonthlyCharges": mc, "tenure": ten, "Contract": c}
        exp = [walk(t, row) for t in range(60)]
        # chunks of 20 trees are summed first, then the chunk totals
        chunked = sum(sum(exp[i:i + 20]) for i in range(0, 60, 20))
        assert abs(g - chunked) < 1e-9
