"""Reproducible stratified splits and folds.

Rows of each class are ordered by ``md5(concat(key, seed))`` (ties by key)
and cut at the cumulative fractions of that class's size. The rank inside a
class is counted in buckets of the hash, so even a
two-class label is ranked by many tasks, not one per class. md5 exists in
both Spark and DuckDB, so the assignment is checkable row for row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayput import presets
from stayput.operators.ordered import MAX_BROADCAST_ROWS, null_safe

HASH = "_h"
BUCKET = "_hb"
#: Leading bits of the hash that name a bucket; a class is ranked by that many windows.
BUCKET_BITS = 10


def class_rank(df: DataFrame, key: str, label: str, seed: int = presets.SEED, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Adds ``class_rank`` (0-based place of the key in hash order within the class) and ``class_size`` (keys of the class).

    Rows that repeat a key share its rank, so they fall into one split or fold whatever order they come in. Null
    labels are a class of their own. The hash is uniform, so its leading bits are even buckets: no count and no quantile pass.
    """
    h = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))
    rows = df.withColumn(HASH, h).withColumn(BUCKET, F.shiftright(F.conv(F.substring(h, 1, 4), 16, 10).cast("int"), 16 - bucket_bits))
    w = Window.partitionBy(label, BUCKET).orderBy(HASH, key)
    placed = rows.withColumn("_place", F.dense_rank().over(w))
    sizes = placed.groupBy(label, BUCKET).agg(F.max("_place").alias("_n"))   # classes x buckets
    upto = Window.partitionBy(label).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(label, BUCKET, F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(label)).alias("class_size"))
    most = MAX_BROADCAST_ROWS >> bucket_bits
    if df.select(label).distinct().limit(most + 1).count() <= most:
        offsets = F.broadcast(offsets)
    joined = placed.alias("r").join(offsets.alias("o"), null_safe("r", "o", [label, BUCKET]))
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in df.columns],
                         (F.col("_before") + F.col("_place") - 1).alias("class_rank"), "class_size")


def cumulative_cuts(fractions: Mapping[str, float]) -> list[tuple[str, float]]:
    acc, cuts = 0.0, []
    for name, f in fractions.items():
        acc = round(acc + f, 12)
        cuts.append((name, acc))
    return cuts


def split_column(rank: Column, size: Column, fractions: Mapping[str, float]) -> Column:
    cuts = cumulative_cuts(fractions)
    expr = None
    for name, cum in cuts[:-1]:
        cond = rank < F.floor(size * F.lit(cum))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(cuts[-1][0]))


def stratified_split(df: DataFrame, key: str, label: str,
                     fractions: Mapping[str, float] = presets.SPLIT_FRACTIONS,
                     seed: int = presets.SEED, **kw) -> DataFrame:
    """Adds ``split`` with class shares equal to ``fractions`` (floor per class)."""
    ranked = class_rank(df, key, label, seed, **kw)
    return ranked.withColumn("split", split_column(F.col("class_rank"), F.col("class_size"), fractions)) \
        .drop("class_rank", "class_size")


def assign_folds(df: DataFrame, key: str, label: str, k: int = presets.CV_FOLDS,
                 seed: int = presets.SEED, **kw) -> DataFrame:
    """``fold`` = class rank mod k — every fold gets each class's share to within one row."""
    ranked = class_rank(df, key, label, seed, **kw)
    return ranked.withColumn("fold", F.pmod(F.col("class_rank"), F.lit(k)).cast("int")) \
        .drop("class_rank", "class_size")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """T4: rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def pos_weight(df: DataFrame, label: str, positive=1) -> DataFrame:
    """T5: round(neg / pos, 4); 1.0 without positives."""
    pos = F.count_if(F.col(label) == positive)
    neg = F.count_if(F.col(label) != positive)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg")).select(
        "n_pos", "n_neg",
        F.when(F.col("n_pos") > 0, F.round(F.col("n_neg") / F.col("n_pos"), 4))
         .otherwise(F.lit(1.0)).alias("scale_pos_weight"))
