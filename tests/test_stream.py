"""The streaming scorer gives the batch result; malformed lines go to the reject sink."""

import tempfile

from pyspark.sql import functions as F

from stayput import catalog
from stayput.operators import score
from stayput.streaming.scoring import score_stream
from tests.conftest import SF001


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="stayput-stream-")
    recs = catalog.subscriber_records_json(spark, SF001).select("value")
    bad = spark.createDataFrame([("{not json",)], "value string")
    recs.unionByName(bad).write.text(f"{d}/in")
    trees = score.worked_example_trees(spark)
    q = score_stream(spark, f"{d}/in", lambda df: score.score_ensemble(df, trees),
                     f"{d}/out", f"{d}/ckpt", f"{d}/rej")
    q.awaitTermination()
    out = spark.read.parquet(f"{d}/out").select("customerID", F.round("probability", 9).alias("p"), "risk_tier")
    batch = catalog.scored_subscribers(spark, SF001).join(
        catalog.subscriber_records_json(spark, SF001).select("customerID"), "customerID", "left_semi") \
        .select("customerID", F.round("probability", 9).alias("p"), "risk_tier")
    assert out.count() == batch.count() > 0
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
    assert spark.read.parquet(f"{d}/rej").count() == 1


def test_restart_does_not_duplicate(spark):
    """Restarting on the same checkpoint processes nothing twice (recovery after a lost driver/executor)."""
    d = tempfile.mkdtemp(prefix="stayput-restart-")
    catalog.subscriber_records_json(spark, SF001).select("value").write.text(f"{d}/in")
    trees = score.worked_example_trees(spark)
    for _ in range(2):
        q = score_stream(spark, f"{d}/in", lambda df: score.score_ensemble(df, trees),
                         f"{d}/out", f"{d}/ckpt")
        q.awaitTermination()
    out = spark.read.parquet(f"{d}/out")
    assert out.count() == out.select("customerID").distinct().count() > 0
