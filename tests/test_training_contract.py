"""Training and prediction as a user calls them: defaults, any target, absent columns, weights of train rows only."""

import inspect
import json

from pyspark.sql import functions as F

from stayput import catalog, presets
from stayput.operators import decide, score, train
from stayput.plans import training
from stayput.sources import io
from stayput.streaming.scoring import score_stream
from tests.conftest import SF001


def test_defaults_are_the_full_search():
    d = {k: p.default for k, p in inspect.signature(training.fit).parameters.items()}
    assert d["space"] is presets.SEARCH_SPACE and d["n_candidates"] == 30 and d["k"] == 5
    cands = train.sample_candidates()
    assert len(cands) == 30 == len({json.dumps(c, sort_keys=True) for c in cands})
    assert {c["scale_pos_weight"] for c in cands} == {1.0, None}
    assert len(train.sample_candidates({"a": [1, 2], "b": [3]}, 30)) == 2


def test_other_target_absent_column_and_records(spark, tmp_path):
    raw = catalog._records(spark, SF001).withColumn("outcome", F.when(F.col(presets.TARGET) == "Yes", "stay").otherwise("leave")) \
        .drop(presets.TARGET)
    tm = training.fit(raw.unionByName(raw.limit(20)), target="outcome", space={"n_estimators": [3], "max_depth": [3]}, n_candidates=1, k=2)
    assert tm.labels == ["leave", "stay"] and tm.search_error is None
    assert tm.data.count() == raw.count()           # copies of rows are dropped before the split
    got = training.predict(tm, raw.drop("outcome", "TechSupport")).select("prediction").distinct().collect()
    assert {r.prediction for r in got} <= {"leave", "stay"}
    # records in the shape of the service: no id, fractional tenure, missing charges
    rows = [{**presets.DEFAULT_ROW, "tenure": 3.5}, {k: v for k, v in presets.DEFAULT_ROW.items() if k != "TotalCharges"}, {"tenure": 1}]
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("\n".join([*map(json.dumps, rows), "not json"]))
    q = score_stream(spark, str(src), training.model_scorer(tm), str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "bad"))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 3 and out.where("probability is null").count() == 0
    assert spark.read.parquet(str(tmp_path / "bad")).collect()[0].value == "not json"
    batch, _ = io.parse_records(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
    want = sorted(r.probability for r in training.model_scorer(tm)(batch).collect())
    assert sorted(r.probability for r in out.collect()) == want


def test_large_ensemble_equals_compiled(spark):
    df = catalog._records(spark, SF001).limit(60)
    trees = score.weighted_copies(presets.WORKED_EXAMPLE_TREES, [1 / 8] * 170)   # 510 trees
    one = [c for c in score.compile_trees(df, presets.WORKED_EXAMPLE_TREES)]
    base = df.select("customerID", (one[0] + one[1] + one[2]).alias("s"))
    got = {r.customerID: r.raw_score for r in score.ensemble_score(df, trees).collect()}
    for r in base.collect():
        assert abs(got[r.customerID] - 170 / 8 * r.s) < 1e-9
    assert decide.with_value_at_risk(score.score_ensemble(df, trees)).count() == df.count()
