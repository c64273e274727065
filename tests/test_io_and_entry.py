"""Driver contract, sources / sinks, schema checks."""

import datetime
import tempfile

import pytest

import __spark_entry__ as E
from stayput import presets
from stayput.operators import clean, encode
from stayput.sources import io
from tests.conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r["risk_tier"] for r in rows] == ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
    assert sum(r["customers"] for r in rows) == 150
    assert set(E.oracle_sql()) <= set(E.queries())


def test_sinks_and_registry(spark):
    d = tempfile.mkdtemp(prefix="stayput-test-")
    subs = E.queries()["p2_reorder_columns"](spark, SF001)
    io.write_table(subs, f"{d}/csv", "csv")
    back = io.read_customers(spark, f"{d}/csv")
    assert back.count() == subs.count() and back.schema == io.SUBSCRIBER_SCHEMA
    fits = spark.createDataFrame([(1, 0.8)], "candidate int, score double")
    io.append_fits(fits, f"{d}/fits")
    io.append_fits(fits, f"{d}/fits")
    assert spark.read.json(f"{d}/fits").count() == 2
    io.write_metrics(fits, f"{d}/metrics")
    reg = spark.createDataFrame([("m1", datetime.datetime(2026, 1, 1)), ("m2", datetime.datetime(2026, 2, 1))],
                                "path string, saved_at timestamp")
    assert io.latest_version(reg).first()["path"] == "m2"
    t = io.template(spark).first()
    assert t["tenure"] == 12 and t["Contract"] == "Month-to-month"


def test_parse_records_rejects(spark):
    df = spark.createDataFrame([('{"tenure": 5, "Contract": "One year"}',), ("not json",)], "value string")
    ok, bad = io.parse_records(df)
    assert ok.count() == 1 and bad.count() == 1
    assert ok.first()["tenure"] == 5


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "Yes")], "n int, s string, x double, Departed string")
    assert clean.column_kinds(df, "Departed") == (["n", "x"], ["s"])
    clean.validate(df, "Departed")
    with pytest.raises(ValueError):
        clean.validate(df, "missing")
    with pytest.raises(ValueError):
        clean.validate(df.where("n > 5"), "Departed")
    with pytest.raises(TypeError):
        clean.assert_numeric(df)
    clean.assert_numeric(df, ["n", "x"])


def test_assemble_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    v = encode.assemble(df, ["c", "a"]).first()["features"]
    assert list(v.toArray()) == [3.0, 1.0]


def test_feature_plan_order_and_reuse(spark):
    from stayput.plans.feature_plan import FeaturePlan
    s = E.queries()["p2_reorder_columns"](spark, SF001).select(*presets.INPUT_COLUMNS, presets.TARGET)
    plan = FeaturePlan(target="Departed", id_columns=["customerID"], exclude_ids=False).fit(s)
    names = plan.state.feature_names
    expected = (presets.INPUT_COLUMNS + ["MonthlyCharges_is_na", "TotalCharges_is_na"]
                + presets.ENGINEERED_FEATURES
                + ["SeniorCitizen_zscore", "tenure_zscore", "MonthlyCharges_zscore", "TotalCharges_zscore"])
    assert names == expected
    # the fitted state is reused: transforming a single row gives the same columns, no refit
    one = plan.transform(s.limit(1))
    assert [c for c in one.columns if c != "Departed"] == expected
