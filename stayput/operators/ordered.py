"""Exact running totals over a global order, without a single-task window.

``Window.orderBy(x)`` with no partition key moves every row into one task.
Here the ordered rows (already unique per ``by`` + order value) are cut into
value buckets whose bounds are approximate quantiles of the order column;
running sums are taken *within* each (group, bucket) window, and the
exclusive prefix of the per-bucket totals (a table of at most
``max_buckets`` rows per group) is joined back with a size-checked
broadcast. The result is exact; the quantiles only balance the work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 16_384
MAX_BROADCAST_ROWS = 1_000_000
BUCKET = "_bucket"


def _bucketize(df: DataFrame, order_col: str, n_rows: int,
               rows_per_bucket: int, max_buckets: int) -> DataFrame:
    n_buckets = min(max_buckets, max(1, math.ceil(n_rows / rows_per_bucket)))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    # bounded: at most max_buckets - 1 doubles reach the driver; a small input is cut at zero, without a pass over it
    bounds = df.stat.approxQuantile(order_col, probs, 1.0 / (2 * n_buckets)) if probs else [0.0]
    inner = sorted(set(b for b in bounds if b is not None and math.isfinite(b))) or [0.0]
    splits = [-math.inf, *inner, math.inf]
    tmp = "_order_dbl"
    return Bucketizer(splits=splits, inputCol=tmp, outputCol=BUCKET, handleInvalid="keep") \
        .transform(df.withColumn(tmp, F.col(order_col).cast("double"))).drop(tmp)


def null_safe(left: str, right: str, names: Sequence[str]):
    """Equality of all ``names`` in which null equals null, as grouping has it."""
    cond = F.lit(True)
    for c in names:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def running_totals(df: DataFrame, order_col: str, measures: Sequence[str],
                   by: Sequence[str] = (), descending: bool = True,
                   next_cols: Sequence[str] = (),
                   tiebreak: Sequence[str] = (),
                   with_totals: bool = False,
                   rows_per_bucket: int = ROWS_PER_BUCKET,
                   max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """Add ``cum_<m>`` = inclusive running sum of ``m`` in ``order_col`` order per ``by``.

    ``df`` must hold one row per (``by``, ``order_col``) value (aggregate
    first), or ``tiebreak`` columns must make the order total; the bucket is
    taken from ``order_col`` alone, so ties never straddle buckets.
    ``next_cols`` adds ``next_<c>``: the value of ``c`` on the
    following row of the same group (null on the last row).
    ``with_totals`` adds ``tot_<m>``: the group total, from the same stages.

    A null in a ``by`` column is a group like any other. Inputs of every size take
    the same path; only the number of buckets differs, and it does not change the result.
    """
    by = list(by)
    bdf = _bucketize(df, order_col, df.count(), rows_per_bucket, max_buckets)
    keys = [order_col, *tiebreak]
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    bucket_order = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    w_lead = Window.partitionBy(*by, BUCKET).orderBy(*order)
    w_in = w_lead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bdf.select("*", *[F.sum(m).over(w_in).alias(f"_in_{m}") for m in measures],
                     *[F.lead(c).over(w_lead).alias(f"_lead_{c}") for c in next_cols],
                     *([F.lead(F.lit(1)).over(w_lead).isNull().alias("_last")] if next_cols else []))

    # per-bucket totals -> exclusive prefix over buckets (small table)
    totals = bdf.groupBy(*by, BUCKET).agg(
        *[F.sum(m).alias(f"_tot_{m}") for m in measures],
        *([(F.max_by if descending else F.min_by)(
            F.struct(*[F.col(c) for c in next_cols]), F.col(order_col)).alias("_first")]
          if next_cols else []),
    )
    w_b = Window.partitionBy(*by).orderBy(bucket_order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    w_b_next = Window.partitionBy(*by).orderBy(bucket_order)
    w_g = Window.partitionBy(*by)
    offsets = totals.select(
        *by, BUCKET,
        *[F.coalesce(F.sum(f"_tot_{m}").over(w_b), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *([F.lead("_first").over(w_b_next).alias("_next_first")] if next_cols else []),
        *([F.sum(f"_tot_{m}").over(w_g).alias(f"tot_{m}") for m in measures] if with_totals else []),
    )
    n_buckets = max_buckets if rows_per_bucket < ROWS_PER_BUCKET else MAX_BUCKETS
    if _offsets_fit(df, by, n_buckets):
        offsets = F.broadcast(offsets)
    joined = out.alias("r").join(offsets.alias("o"), null_safe("r", "o", [*by, BUCKET]), "inner")
    cols = [F.col(f"r.{c}").alias(c) for c in df.columns]
    cols += [(F.col(f"_off_{m}") + F.col(f"_in_{m}")).alias(f"cum_{m}") for m in measures]
    cols += [F.when(F.col("_last"), F.col(f"_next_first.{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}")
             for c in next_cols]
    cols += [F.col(f"tot_{m}") for m in measures] if with_totals else []
    return joined.select(*cols)


def _offsets_fit(df: DataFrame, by: Sequence[str], n_buckets: int) -> bool:
    """Broadcast the offsets only under a proven row bound: groups * buckets."""
    if not by:
        return n_buckets <= MAX_BROADCAST_ROWS
    limit = max(1, MAX_BROADCAST_ROWS // n_buckets)
    n_groups = df.select(*by).distinct().limit(limit + 1).count()
    return n_groups <= limit


def join_small(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Join a per-group table (one row per group) to the rows of those groups.

    A shuffle join on a low-cardinality key would put whole groups (a class, a
    split) in one task, so the small side is broadcast once its row count is
    proven below ``max_rows`` (``known_rows`` when the driver already knows the
    bound, e.g. one row per listed column); above that a regular (AQE-managed) join.
    """
    n = known_rows if known_rows is not None else small.limit(max_rows + 1).count()
    if n <= max_rows:
        return df.join(F.broadcast(small), on=list(on), how=how)
    return df.join(small, on=list(on), how=how)


def global_rank(df: DataFrame, keys: Sequence[str], out: str = "rank",
                rows_per_part: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact 0-based rank of each row in ``keys`` order (rows unique per ``keys``), for any key type.

    Small inputs use one window. Larger ones are range-partitioned — the
    partitioner samples whole keys, so long shared string prefixes still
    split evenly — ranked inside each range, and shifted by the exclusive
    prefix of the range sizes (at most ``MAX_BUCKETS`` rows, broadcast).
    The range assignment is written to the shared checkpoint folder first,
    so a lost executor cannot recompute rows into a different range.
    """
    from stayput.session import shared_dir

    n = df.count()
    parts = min(MAX_BUCKETS, max(1, math.ceil(n / rows_per_part)))
    order = [F.col(k).asc() for k in keys]
    if parts == 1:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)) - 1)
    shared_dir(df.sparkSession, "ranks")
    ranged = df.repartitionByRange(parts, *keys).withColumn("_pid", F.spark_partition_id()) \
        .checkpoint(eager=True)
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return local.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.col("_local")) \
        .drop("_pid", "_local", "_off")
