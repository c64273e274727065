"""Scans and sinks (S1-S8): CSV / parquet / JSON subscriber tables, logs, state, registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayput import presets
from stayput.operators.clean import nan_to_null
from stayput.operators.score import TreeModel, as_table, tree_rows

SUBSCRIBER_SCHEMA = T.StructType(
    [T.StructField("customerID", T.StringType()), T.StructField("gender", T.StringType()),
     T.StructField("SeniorCitizen", T.IntegerType()), T.StructField("Partner", T.StringType()),
     T.StructField("Dependents", T.StringType()), T.StructField("tenure", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in presets.INPUT_COLUMNS[6:18]]
    + [T.StructField("MonthlyCharges", T.DoubleType()), T.StructField("TotalCharges", T.DoubleType()),
       T.StructField(presets.TARGET, T.StringType())])

# the typed single-record form: every field optional, no id, no target; tenure may be fractional
RECORD_SCHEMA = T.StructType([T.StructField(f.name, T.DoubleType()) if f.name == "tenure" else f
                              for f in SUBSCRIBER_SCHEMA.fields if f.name not in ("customerID", presets.TARGET)])


def read_customers(spark: SparkSession, path: str, fmt: str = "csv",
                   schema: T.StructType = SUBSCRIBER_SCHEMA) -> DataFrame:
    """Explicit schema (no inference pass), header, permissive parsing (bad fields -> null); NaN is read as null."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("nullValue", "").csv(path))
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[nan_to_null(c).alias(c) if c in floating else F.col(c) for c in df.columns])


#: Types that an inferred column may have, narrowest first; what fits none is text.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def read_inferred(spark: SparkSession, path: str, sample_rows: int = 10_000, null_value: str = "", **options) -> tuple[DataFrame, DataFrame]:
    """S1 for a foreign CSV: (typed rows, report of one row per column: column, type, cells, nulls, bad, example).

    Each column gets the narrowest of INFERRED that all its values in the first ``sample_rows`` rows can be cast to (text if none, or if
    the sample holds no value). Then one pass over all rows counts the cells that do not cast; they read as null, and ``bad`` says so.
    """
    raw = spark.read.option("header", True).option("nullValue", null_value).options(**options).csv(path)
    names = raw.columns

    def cell(c):
        return F.trim(F.col(f"`{c}`"))

    def fits(c, kind):
        return F.count_if(F.expr(f"try_cast(trim(`{c}`) AS {kind})").isNotNull())

    seen = raw.limit(sample_rows).agg(*[F.count(cell(c)).alias(f"n{i}") for i, c in enumerate(names)],
                                      *[fits(c, k).alias(f"{k}{i}") for i, c in enumerate(names) for k in INFERRED]).first()
    kinds = {c: next((k for k in INFERRED if seen[f"n{i}"] and seen[f"{k}{i}"] == seen[f"n{i}"]), "string") for i, c in enumerate(names)}
    typed = raw.select(*[F.expr(f"try_cast(trim(`{c}`) AS {kinds[c]})").alias(c) if kinds[c] != "string" else F.col(f"`{c}`") for c in names])
    bad = {c: F.expr(f"try_cast(trim(`{c}`) AS {kinds[c]})").isNull() & F.col(f"`{c}`").isNotNull() if kinds[c] != "string" else F.lit(False) for c in names}
    counted = raw.agg(F.count(F.lit(1)).alias("cells"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls{i}") for i, c in enumerate(names)],
                      *[F.count_if(bad[c]).alias(f"bad{i}") for i, c in enumerate(names)],
                      *[F.min(F.when(bad[c], F.col(f"`{c}`"))).alias(f"example{i}") for i, c in enumerate(names)])
    report = counted.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col("cells"), F.col(f"nulls{i}").alias("nulls"),
                 F.col(f"bad{i}").alias("bad"), F.col(f"example{i}").alias("example")) for i, c in enumerate(names)])).alias("r")).select("r.*")
    return typed, report


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Header CSV (or parquet / json). Never overwrite a path that ``df`` itself reads."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def append_fits(df: DataFrame, path: str) -> None:
    """S3: one JSON line per fit / candidate, appended."""
    df.write.mode("append").json(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics / summary rows as JSON."""
    df.write.mode("overwrite").json(path)


def save_state(tables: dict[str, DataFrame], path: str, model=None) -> None:
    """Fitted state as small parquet tables, with the model: a boosted ensemble as its tree table, an MLlib model in its own form.

    ``versions.save`` writes the same as a version that readers see only once it is complete.
    """
    for name, t in tables.items():
        t.write.mode("overwrite").parquet(f"{path}/state/{name}")
        spark = t.sparkSession
    if hasattr(model, "rows"):
        as_table(spark, model.rows()).write.mode("overwrite").parquet(f"{path}/trees")
    elif model is not None:
        model.write().overwrite().save(f"{path}/model")


def load_state(spark: SparkSession, path: str, names=("encoders", "impute", "stats", "features", "columns")):
    from pyspark.ml.classification import GBTClassificationModel
    tables = {n: spark.read.parquet(f"{path}/state/{n}") for n in names}

    def saved(kind: str) -> bool:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}")
        return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    if saved("trees"):
        return tables, TreeModel(tree_rows(spark.read.parquet(f"{path}/trees")))
    return tables, GBTClassificationModel.load(f"{path}/model") if saved("model") else None


def latest_version(registry: DataFrame, key: str = "path", ts: str = "saved_at") -> DataFrame:
    """The most recently saved entry (one aggregation; no driver-side sort); of equal times the greatest key."""
    return registry.agg(F.max_by(key, F.struct(ts, key)).alias(key), F.max(ts).alias(ts))


def parse_records(df: DataFrame, value: str = "value", schema: T.StructType = RECORD_SCHEMA,
                  keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """JSON text -> typed record columns. Returns (parsed, rejected); unparsable rows go to the reject side."""
    parsed = df.select(*keep, F.col(value), json_struct(F.col(value), schema).alias("r"))
    malformed = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    ok = parsed.where(~malformed).select(*keep, *[f"r.{f.name}" for f in schema.fields])
    bad = parsed.where(malformed).select(*keep, value)
    return ok, bad


CORRUPT = "_corrupt_record"


def json_struct(text, schema: T.StructType):
    """Permissive ``from_json`` that keeps unparsable text in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def template(spark: SparkSession) -> DataFrame:
    """The default record as a one-row table."""
    return spark.createDataFrame([presets.DEFAULT_ROW | {"tenure": float(presets.DEFAULT_ROW["tenure"])}], RECORD_SCHEMA)
