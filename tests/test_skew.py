"""Hot groups are split: bucket sizes stay near the target even when one class holds half the rows."""

from pyspark.sql import functions as F

from stayput.operators import split
from stayput.operators.evaluate import ranking_metrics
from tests.conftest import SF01


def test_hot_class_is_split_into_even_buckets(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderstatus")
    n = o.count()
    top = o.groupBy("o_orderstatus").count().agg(F.max("count")).first()[0]
    assert top > n / 3                      # one class holds more than a third of the rows
    ranked = split.class_rank(o, "o_orderkey", "o_orderstatus", bucket_bits=4)
    assert ranked.count() == n
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan     # no window over a whole class or table
    h = F.shiftright(F.conv(F.substring(F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("42"))), 1, 4), 16, 10).cast("int"), 12)
    sizes = [r["count"] for r in o.groupBy("o_orderstatus", h.alias("b")).count().collect()]
    assert max(sizes) <= 1.5 * top / 16      # so the hot class is spread over many window partitions


def test_null_groups_and_repeated_keys(spark):
    rows = [(i, None if i % 10 == 0 else i % 2, float(i % 37)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    a = {(r.k, r.split) for r in split.stratified_split(df, "k", "y").collect()}
    assert len(a) == 1000
    assert a == {(r.k, r.split) for r in split.stratified_split(df, "k", "y", bucket_bits=2).collect()}
    one, many = (sorted(((str(r.y), r.n_pos, r.n_neg, r.roc_auc, round(r.average_precision, 12))
                         for r in ranking_metrics(df.withColumn("t", (F.col("k") % 3 == 0).cast("int")), "t", "s", by=["y"], **kw).collect()))
                 for kw in ({}, {"rows_per_bucket": 5}))
    assert len(one) == 3 and one == many
    twice = df.unionByName(df)
    folds = [{(r.k, r.fold) for r in split.assign_folds(x, "k", "y", 5).collect()} for x in (twice, twice.orderBy(F.desc("k")))]
    assert folds[0] == folds[1] and len(folds[0]) == 1000   # a key is in one fold, whatever the row order
