"""Projection, validation, cleaning and imputation operators.

Fitted statistics are computed with distributed aggregations and returned
as small Python dicts (one value per column — bounded by the schema width),
then applied as literals so the transform stays a narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayput.functions.columns import nan_to_null

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------------------
# P: projections, predicates, checks
# ---------------------------------------------------------------------------
def drop_target(df: DataFrame, target: str) -> DataFrame:
    """P1."""
    return df.drop(target)


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Listed columns first (when present), the rest after in their original order."""
    lead = [c for c in first if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def align_features(df: DataFrame, names: Sequence[str], fill=0) -> DataFrame:
    """Select ``names`` in order; missing columns become ``fill`` (0 or null)."""
    have = set(df.columns)
    cols = []
    for c in names:
        if c in have:
            cols.append(F.col(c))
        elif fill is None:
            cols.append(F.lit(None).cast("double").alias(c))
        else:
            cols.append(F.lit(fill).alias(c))
    return df.select(*cols)


def add_missing(df: DataFrame, names: Sequence[str], fill=0) -> DataFrame:
    """P3 for tables that keep their other columns: the ``names`` that are absent become ``fill``."""
    return df.select("*", *[F.lit(fill).alias(c) for c in names if c not in df.columns])


def column_kinds(df: DataFrame, target: str | None = None,
                 exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """P5: (numeric, categorical) column names from the schema, minus target and excluded."""
    skip = set(exclude) | ({target} if target else set())
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def validate(df: DataFrame, target: str | None = None, rows: int | None = None) -> None:
    """Raise on a missing target or an empty input (``rows`` if already counted)."""
    if target is not None and target not in df.columns:
        raise ValueError(f"no column named {target!r} to predict")
    if (rows == 0) if rows is not None else df.isEmpty():
        raise ValueError("the table has no rows")


def assert_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> None:
    """Every feature column numeric or boolean; lists the offenders."""
    bad = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields
           if (cols is None or f.name in cols)
           and not isinstance(f.dataType, (*NUMERIC_TYPES, T.BooleanType))]
    if bad:
        raise TypeError(f"non-numeric feature columns: {bad}")


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric / string column counts, total missing cells, null or NaN (one aggregation)."""
    num, cat = column_kinds(df)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    nulls = [F.count_if((F.col(c).isNull() | F.isnan(c)) if c in floating else F.col(c).isNull()) for c in df.columns]
    total_nulls = nulls[0]
    for n in nulls[1:]:
        total_nulls = total_nulls + n
    return df.agg(F.count(F.lit(1)).alias("rows"), total_nulls.cast("bigint").alias("null_cells")) \
        .select("rows", F.lit(len(df.columns)).alias("columns"), F.lit(len(num)).alias("numeric_columns"),
                F.lit(len(cat)).alias("string_columns"), "null_cells")


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Null count per column plus the row count under the key ``None`` (one aggregation)."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]).first()
    out = {c: int(row[f"_n{i}"]) for i, c in enumerate(cols)}
    out[None] = int(row["_rows"])
    return out


# ---------------------------------------------------------------------------
# C: cleaning and imputation
# ---------------------------------------------------------------------------
#: Values of a column that a median ranks at the end of its narrowing.
BRACKET_ROWS = 200_000


def dedupe(df: DataFrame) -> DataFrame:
    """Full-row distinct. Map-side partial aggregation collapses hot duplicates before the shuffle."""
    return df.dropDuplicates()


def dedupe_report(df: DataFrame) -> DataFrame:
    """C1 report: rows before, after, removed — one grouping by the full row, then one total."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.sum("_copies").cast("bigint").alias("rows_before"),
                      F.count(F.lit(1)).alias("rows_after")) \
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def fit_missing_flags(df: DataFrame, cols: Sequence[str], with_rows: bool = False):
    """C2 fit: the numeric columns that contain a null (fixed at fit time for a stable schema).

    With ``with_rows`` also returns the row count from the same aggregation.
    """
    counts = null_counts(df.select(*[nan_to_null(c).alias(c) for c in cols]), cols)
    flags = [c for c in cols if counts[c] > 0]
    return (flags, counts[None]) if with_rows else flags


def add_missing_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C2 apply: ``<col>_is_na`` = 1 where the value is missing (before imputation)."""
    return df.select("*", *[nan_to_null(c).isNull().cast("int").alias(f"{c}_is_na") for c in cols])


def _long(df: DataFrame, cols: Sequence[str], value_type: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               (nan_to_null(c) if value_type == "double" else F.col(c))
                               .cast(value_type).alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("kv")).select("kv.column", "kv.value") \
        .where(F.col("value").isNotNull())


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> dict:
    """Rows of the table (under None), and of each column the number of its values (null and NaN are none), their mean, the sum of squares
    about it, and quantiles around the middle: one aggregation, from which missing flags, moments and the first bracket of the median follow."""
    aggs = []
    for i, c in enumerate(cols):
        v = nan_to_null(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), (F.var_pop(v) * F.count(v)).alias(f"s{i}"),
                 F.percentile_approx(v, _around(0.5), F.lit(10_000)).alias(f"q{i}")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()
    found = {c: {"n": row[f"n{i}"], "mean": row[f"m{i}"], "squares": row[f"s{i}"], "around": row[f"q{i}"]} for i, c in enumerate(cols)}
    return {None: int(row["rows"]), **found}


def imputed_moments(profile: dict, medians: dict) -> dict[str, dict[str, float]]:
    """Mean and sample deviation of each column once its missing cells hold the median, from the profile alone."""
    out = {}
    for c, m in medians.items():
        p = profile[c]
        n, k = p["n"], profile[None] - p["n"]
        if m is None or n == 0:
            out[c] = {"mean": None, "std": None}
            continue
        mean = p["mean"] if k == 0 else (n * p["mean"] + k * m) / (n + k)
        squares = p["squares"] + n * (p["mean"] - mean) ** 2 + k * (m - mean) ** 2
        out[c] = {"mean": mean, "std": (squares / (n + k - 1)) ** 0.5 if n + k > 1 else None}
    return out


def _around(mid: float) -> list[float]:
    return [min(1.0, max(0.0, mid - 0.002)), min(1.0, max(0.0, mid + 0.002))]


def median_table(df: DataFrame, cols: Sequence[str], rows_per_bucket: int = BRACKET_ROWS, profile: dict | None = None) -> DataFrame:
    """Exact interpolated median per column (pandas ``median``) as (column, median).

    Each pass is one aggregation to one row: it counts the values below and inside every column's bracket and
    takes approximate quantiles around the middle rank as the next bracket. Once a bracket holds few
    values, or shrinks no more (ties), only the values inside it are counted, ranked and read off:
    no column is shuffled whole. Columns without values have no row. A ``profile`` stands for the first pass.
    """
    values = {c: nan_to_null(c).cast("double") for c in cols}
    bracket: dict[str, tuple] = {c: (None, None) for c in cols}
    open_, n, below = list(cols), {}, {c: 0 for c in cols}
    if profile is not None:
        n = {c: (profile[c]["n"], profile[c]["n"]) for c in cols}
        open_ = [c for c in cols if profile[c]["n"] > rows_per_bucket and profile[c]["around"]]
        bracket.update({c: tuple(profile[c]["around"]) for c in open_})
    while open_:
        aggs = []
        for i, c in enumerate(open_):
            v, (lo, hi) = values[c], bracket[c]
            inside = v.isNotNull() if lo is None else (v >= lo) & (v <= hi)
            total = n.get(c)
            # the middle rank as a share of the values inside; without a total yet, it is their middle
            mid = 0.5 if total is None else ((total[0] - 1) / 2 - below[c]) / max(1, total[1])
            around = _around(mid)
            aggs += [F.count_if(inside).alias(f"n{i}"), F.count_if(v < lo if lo is not None else F.lit(False)).alias(f"b{i}"),
                     F.percentile_approx(F.when(inside, v), around, F.lit(10_000)).alias(f"q{i}")]
        row = df.agg(*aggs).first()
        still = []
        for i, c in enumerate(open_):
            size, q = row[f"n{i}"], row[f"q{i}"]
            first = c not in n
            before = bracket[c]
            k = ((size if first else n[c][0]) - 1) // 2
            if not first and not (row[f"b{i}"] <= k and k + 1 < row[f"b{i}"] + size):
                bracket[c] = (None, None)       # the quantiles missed a middle rank: take the column whole
                below[c] = 0
                continue
            n[c] = (size if first else n[c][0], size)
            below[c] = 0 if first else row[f"b{i}"]
            if size > rows_per_bucket and q and (first or tuple(q) != before):
                bracket[c] = tuple(q)
                still.append(c)
        open_ = still
    inside = [F.when(values[c].isNotNull() if bracket[c][0] is None else values[c].between(*map(F.lit, bracket[c])),
                     F.struct(F.lit(c).alias("column"), values[c].alias("value"))) for c in cols]
    counts = df.select(F.explode(F.array_compact(F.array(*inside))).alias("kv")).select("kv.column", "kv.value") \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offset, total = (F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(v[c]).cast("long"))]), F.col("column"))
                     for v in (below, {c: n[c][0] for c in cols}))
    ranked = counts.withColumn("upto", upto + offset).withColumn("total", total)
    k1, k2 = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    return ranked.groupBy("column").agg(F.min(F.when(F.col("upto") > k1, F.col("value"))).alias("v1"),
                                        F.min(F.when(F.col("upto") > k2, F.col("value"))).alias("v2")) \
        .select("column", ((F.col("v1") + F.col("v2")) / 2).alias("median"))


def fit_median(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    """C3 fit: the median table as a dict (one row per column)."""
    if not cols:
        return {}
    found = {r["column"]: r["median"] for r in median_table(df, cols, **kw).collect()}
    return {c: found.get(c) for c in cols}


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) for the non-null values of string columns (partial + final aggregation)."""
    return _long(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def modes_from_counts(counts: DataFrame) -> DataFrame:
    """(column, mode, n): most frequent value per column, smallest on a tie."""
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value")))
    return counts.groupBy("column").agg(best.alias("b")) \
        .select("column", F.col("b.value").alias("mode"), (-F.col("b.neg_n")).alias("n"))


def mode_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C4: (column, mode, n) — most frequent value, smallest on a tie (two hash aggregations)."""
    counts = value_counts(df, cols)
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value")))
    return counts.groupBy("column").agg(best.alias("b")) \
        .select("column", F.col("b.value").alias("mode"), (-F.col("b.neg_n")).alias("n"))


def fit_mode(df: DataFrame, cols: Sequence[str], missing: str = "Unknown") -> dict[str, str]:
    """C4 fit: mode per column as a dict; all-null -> ``missing``."""
    if not cols:
        return {}
    found = {r["column"]: r["mode"] for r in mode_table(df, cols).collect()}  # one row per column
    return {c: found.get(c, missing) for c in cols}


def apply_impute(df: DataFrame, medians: dict, modes: dict, widen: Sequence[str] = ()) -> DataFrame:
    """C3 / C4 apply: fill nulls (and NaN) with the fitted literals.

    Integer columns keep their type unless listed in ``widen`` (they held
    nulls at fit time) and the median is fractional, as pandas would.
    """
    out = []
    for c in df.columns:
        if c in medians and medians[c] is not None:
            dt = df.schema[c].dataType
            fill = F.lit(medians[c])
            if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
                m = medians[c]
                if c not in widen or float(m).is_integer():
                    out.append(F.coalesce(F.col(c), F.lit(int(round(m))).cast(dt)).alias(c))
                else:
                    out.append(F.coalesce(F.col(c).cast("double"), fill).alias(c))
            else:
                out.append(F.coalesce(nan_to_null(c), fill).alias(c))
        elif c in modes:
            out.append(F.coalesce(F.col(c), F.lit(modes[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_zero(df: DataFrame) -> DataFrame:
    """Remaining numeric nulls -> 0."""
    return df.na.fill(0)


def derive_total(df: DataFrame, total: str = "TotalCharges", tenure: str = "tenure",
                 monthly: str = "MonthlyCharges") -> DataFrame:
    """Missing total charges derived as tenure x monthly charges."""
    return df.withColumn(total, F.coalesce(F.col(total), F.col(tenure) * F.col(monthly)))
