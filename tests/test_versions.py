"""Saved versions, the newest by file time, a stream that takes up new models, typed CSV with a report, the one-pass report."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stayput import catalog, presets
from stayput.operators import boost, portfolio
from stayput.plans import training
from stayput.plans.batch_report import batch_report
from stayput.sources import io, versions
from stayput.streaming.scoring import newest_scorer, score_stream
from tests.conftest import SF001


def one_leaf(base):
    return boost.Boosted([], [], base, [])


@pytest.fixture(scope="module")
def prepared(spark):
    raw = catalog._records(spark, SF001)
    return raw, training.prepare(raw)[0]


def touch(spark, path, when):
    target, files = versions._path(spark, f"{path}/{versions.MANIFEST}")
    files.setTimes(target, when, -1)


def test_newest_complete_version_wins_by_time_not_by_name(spark, tmp_path, prepared):
    raw, plan = prepared
    root = str(tmp_path / "store")
    assert versions.newest(spark, root) is None
    with pytest.raises(FileNotFoundError):
        versions.load(spark, root)
    paths = [versions.save(spark, root, plan, one_leaf(b), ["No", "Yes"], name=n) for b, n in ((0.0, "z"), (1.0, "same"), (2.0, "same"))]
    for p, when in zip(paths, (9_000, 30_000, 20_000)):
        touch(spark, p, when)
    assert versions.newest(spark, root).endswith(paths[1].rsplit("/", 1)[1])
    got = training.predict(versions.load(spark, root), raw.limit(3)).collect()
    assert all(abs(r.probability - 1 / (1 + 2.718281828459045 ** -1.0)) < 1e-12 and r.prediction == "Yes" for r in got)
    touch(spark, paths[0], 40_000)
    assert versions.newest(spark, root).endswith(paths[0].rsplit("/", 1)[1])


def test_half_written_version_is_never_loaded(spark, tmp_path, prepared, monkeypatch):
    _, plan = prepared
    root = str(tmp_path / "store")
    good = versions.save(spark, root, plan, one_leaf(0.5), ["No", "Yes"])
    real = versions._path

    def lost(spark, path):
        if path.endswith(".part"):
            raise RuntimeError("lost")
        return real(spark, path)

    monkeypatch.setattr(versions, "_path", lost)
    with pytest.raises(RuntimeError):
        versions.save(spark, root, plan, one_leaf(7.0), ["No", "Yes"])
    monkeypatch.undo()
    assert len(os.listdir(root)) == 2 and versions.newest(spark, root).endswith(good.rsplit("/", 1)[1])
    assert [r[-1] for r in versions.load(spark, root).model.rows()] == [0.5]


def test_running_stream_takes_a_new_model_between_batches(spark, tmp_path, prepared):
    _, plan = prepared
    root, src = str(tmp_path / "store"), tmp_path / "in"
    src.mkdir()
    first = versions.save(spark, root, plan, one_leaf(-1.0), ["No", "Yes"])
    touch(spark, first, 10_000)
    scorer = newest_scorer(spark, root)
    for k in range(3):
        if k == 1:
            touch(spark, versions.save(spark, root, plan, one_leaf(3.0), ["No", "Yes"]), 20_000)
        (src / f"{k}.txt").write_text(json.dumps({**presets.DEFAULT_ROW, "customerID": f"c{k}"}))
        score_stream(spark, str(src), scorer, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {r.customerID: (r.batch_id, round(r.probability, 4), r.model_version) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert [got[f"c{k}"][:2] for k in range(3)] == [(0, 0.2689), (1, 0.9526), (2, 0.9526)]
    assert got["c0"][2] == first.rsplit("/", 1)[1] != got["c1"][2] == got["c2"][2]


def test_null_keeping_plan_has_a_learner(spark, tmp_path):
    raw = catalog._records(spark, SF001)
    tm = training.fit(raw, space={"n_estimators": [6], "max_depth": [3]}, n_candidates=1, k=2, keep_nulls=True)
    assert tm.search_error is None and tm.model.trees
    holes = raw.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("MonthlyCharges", "Contract", "tenure") else F.col(f.name)
                         for f in raw.schema.fields])
    got = training.predict(tm, holes)
    assert got.count() == raw.count() and got.where("probability IS NULL OR prediction IS NULL").count() == 0
    path = versions.save(spark, str(tmp_path / "v"), tm.plan, tm.model, tm.labels)
    again = training.predict(versions.load(spark, str(tmp_path / "v"), path), holes)
    a, b = (x.select("customerID", F.round("probability", 9)) for x in (got, again))
    assert a.exceptAll(b).count() == 0
    tm.release()


def test_target_needs_two_values(spark):
    raw = catalog._records(spark, SF001)
    for bad in (F.lit("leave"), F.lit(None).cast("string"), (F.col("tenure") % 3).cast("string")):
        with pytest.raises(ValueError):
            training.target_codes(raw.withColumn("t", bad), "t")


def test_foreign_csv_reads_typed_and_reports_bad_cells(spark, tmp_path):
    lines = ["id,amount,when,note,flag,empty"] + [f"{i},{i / 4},2024-01-{i % 28 + 1:02d},n{i},{'true' if i % 2 else 'false'}," for i in range(50)]
    lines += ["x7,1.5,2024-02-30,last,maybe,", " 51 ,,2024-03-01,,true,"]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    df, report = io.read_inferred(spark, str(tmp_path / "f.csv"), sample_rows=40)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "double", "date", "string", "boolean", "string"]
    got = {r["column"]: (r.type, r.cells, r.nulls, r.bad, r.example) for r in report.collect()}
    assert got["id"] == ("int", 52, 0, 1, "x7") and got["when"][3:] == (1, "2024-02-30") and got["flag"][3:] == (1, "maybe")
    assert got["amount"] == ("double", 52, 1, 0, None) and got["empty"] == ("string", 52, 52, 0, None) and got["note"][2] == 1
    assert df.where("id IS NULL").count() == 1 and df.where("id = 51").count() == 1
    (tmp_path / "g.csv").write_text("a,b\n")
    df, report = io.read_inferred(spark, str(tmp_path / "g.csv"))
    assert df.columns == ["a", "b"] and df.count() == 0 and [(r.type, r.cells, r.bad) for r in report.collect()] == [("string", 0, 0)] * 2


def test_report_counts_while_it_writes(spark, tmp_path):
    scored = catalog.scored_subscribers(spark, SF001)
    rep = batch_report(scored, sink=str(tmp_path / "csv"))
    assert [tuple(r) for r in rep["kpis"].collect()] == [tuple(r) for r in portfolio.kpis(scored).collect()]
    assert [tuple(r) for r in rep["tiers"].collect()] == [tuple(r) for r in portfolio.tier_distribution(scored).collect()]
    assert [tuple(r) for r in rep["histogram"].collect()] == [tuple(r) for r in portfolio.probability_histogram(scored).collect()]
    assert [tuple(r) for r in rep["top"].collect()] == [tuple(r) for r in portfolio.top_risk(scored).collect()]
    assert rep["scored"].columns == scored.columns and rep["scored"].exceptAll(scored).count() == 0
    none = batch_report(scored.limit(0))
    assert tuple(none["kpis"].first()) == (0, 0, None, 0, None) and none["histogram"].count() == 0 and none["top"].count() == 0
