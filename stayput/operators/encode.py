"""Categorical encoding.

The dictionary is a DataFrame (column, value, code): codes are the 0-based
position of the value in sorted order, as a label encoder assigns them.
Applying it uses a literal map when the dictionary of a column is small
(no join, stays in codegen) and an equi-join otherwise — broadcast only
below a checked row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput.operators.ordered import global_rank, join_small

ENCODER_SCHEMA = "column string, value string, code int"
MAP_LITERAL_MAX = 100             # entries per column applied as a literal map (a map lookup is a linear scan)
BROADCAST_MAX = 1_000_000         # dictionary rows joined by broadcast
ONE_HOT_MAX = 1_000               # distinct values turned into columns


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return df.select(F.explode(pairs).alias("kv")).select("kv.column", "kv.value")


def fit_labels(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """(column, value, code) with codes 0..n-1 over the sorted distinct non-null values.

    The distinct pairs come from a partial + final aggregation; codes are the
    exact global rank of (column, value) minus the first rank of the column,
    so no column's dictionary is ranked in a single task.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], ENCODER_SCHEMA)
    pairs = _long(df, cols).where(F.col("value").isNotNull()).distinct()
    return labels_from_pairs(pairs, **kw)


def labels_from_pairs(pairs: DataFrame, **kw) -> DataFrame:
    """E1 from distinct (column, value) pairs: codes are ranks within each column."""
    ranked = global_rank(pairs.select("column", "value"), ["column", "value"], **kw)
    first = ranked.groupBy("column").agg(F.min("rank").alias("_first"))  # one row per column
    return join_small(ranked, first, ["column"]).select(
        "column", "value", (F.col("rank") - F.col("_first")).cast("int").alias("code"))


def _dictionary(enc: DataFrame, col: str) -> DataFrame:
    return enc.where(F.col("column") == col).select("value", "code")


def small_dictionaries(enc: DataFrame) -> tuple[dict[str, int], dict[str, list[tuple[str, int]]]]:
    """Which columns are small, and their entries — one bounded read.

    Codes are contiguous (0..n-1), so reading the rows with code <= MAP_LITERAL_MAX
    (at most MAP_LITERAL_MAX + 1 per column) shows both each column's size and,
    for the small ones, every entry. Larger columns are marked with size
    ``MAP_LITERAL_MAX + 1`` and applied through a join.
    """
    rows = enc.where(F.col("code") <= MAP_LITERAL_MAX).collect()
    by_col: dict[str, list[tuple[str, int]]] = {}
    for r in rows:
        by_col.setdefault(r["column"], []).append((r["value"], r["code"]))
    sizes = {c: len(v) for c, v in by_col.items()}
    entries = {c: v for c, v in by_col.items() if len(v) <= MAP_LITERAL_MAX}
    return sizes, entries


def apply_labels(df: DataFrame, enc: DataFrame, cols: Sequence[str] | None = None,
                 unseen: int = 0, keep_nulls: bool = False, missing_as_null: bool = False,
                 dictionaries: tuple | None = None) -> DataFrame:
    """Replace each encoded column by its code; unseen -> ``unseen``.

    ``keep_nulls`` leaves null inputs null (null-keeping variant);
    ``missing_as_null`` adds a null column for an encoder whose column is absent;
    ``dictionaries`` is a cached ``small_dictionaries(enc)`` result.
    """
    sizes, entries = dictionaries if dictionaries is not None else small_dictionaries(enc)
    cols = [c for c in (cols if cols is not None else sizes) if c in sizes]
    out = df
    for c in cols:
        if c not in out.columns:
            if missing_as_null:
                out = out.withColumn(c, F.lit(None).cast("int"))
            continue
        key = F.col(c).cast("string")
        if c in entries:
            rows = entries[c]
            m = F.create_map(*[F.lit(x) for r in rows for x in r]) if rows else None
            code = F.try_element_at(m, key) if m is not None else F.lit(None).cast("int")
            code = F.when(key.isNull(), F.lit(None).cast("int")).otherwise(code)
            enc_col = F.coalesce(code, F.lit(unseen))
            if keep_nulls:
                enc_col = F.when(F.col(c).isNull(), F.lit(None)).otherwise(enc_col)
            out = out.withColumn(c, enc_col.cast("int"))
        else:
            # large dictionary: equi-join, broadcast only under a counted bound
            k = f"_k_{c}"
            d = _dictionary(enc, c).withColumnRenamed("value", k).withColumnRenamed("code", f"_c_{c}")
            # a null joins nothing: spread such rows over distinct keys that no dictionary holds
            spread = F.coalesce(key, F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string")))
            joined = join_small(out.withColumn(k, spread), d, [k], how="left", max_rows=BROADCAST_MAX)
            enc_col = F.coalesce(F.col(f"_c_{c}"), F.lit(unseen))
            if keep_nulls:
                enc_col = F.when(F.col(c).isNull(), F.lit(None)).otherwise(enc_col)
            out = joined.withColumn(c, enc_col.cast("int")).drop(k, f"_c_{c}")
    return out


def unseen_values(df: DataFrame, enc: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) present in ``df`` but not in the dictionary (left anti join)."""
    seen = enc.select("column", "value")
    return (_long(df, cols).where(F.col("value").isNotNull()).distinct()
            .join(seen, ["column", "value"], "left_anti"))


def encode_target(df: DataFrame, target: str, out: str = "label") -> tuple[DataFrame, DataFrame]:
    """Label-encode the target; returns (df with ``out``, mapping table)."""
    enc = fit_labels(df, [target])
    coded = apply_labels(df.withColumn(out, F.col(target)), enc.withColumn("column", F.lit(out)), [out])
    return coded, enc


def decode(df: DataFrame, enc: DataFrame, col: str, code_col: str, out: str) -> DataFrame:
    """Code -> original value through the dictionary of ``col``."""
    rows = _dictionary(enc, col).limit(MAP_LITERAL_MAX + 1).collect()
    if len(rows) <= MAP_LITERAL_MAX:
        m = F.create_map(*[F.lit(x) for r in rows for x in (r["code"], r["value"])])
        return df.withColumn(out, F.try_element_at(m, F.col(code_col).cast("int")))
    d = _dictionary(enc, col).select(F.col("code").alias("_code"), F.col("value").alias(out))
    keyed = df.withColumn("_code", F.col(code_col).cast("int"))
    return join_small(keyed, d, ["_code"], how="left", max_rows=BROADCAST_MAX).drop("_code")


def fallback_target(col: str, positive: str = "Yes", negative: str = "No"):
    """No -> 0, Yes -> 1, anything else -> 0."""
    c = F.col(col)
    return F.when(c == positive, F.lit(1)).when(c == negative, F.lit(0)).otherwise(F.lit(0))


def fit_one_hot(df: DataFrame, cols: Sequence[str], most: int = ONE_HOT_MAX) -> dict[str, list[str]]:
    """E9 fit: sorted distinct values per column (they become column names, so bounded)."""
    pairs = _long(df, cols).where(F.col("value").isNotNull()).distinct().persist()
    big = (pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > most).select("column").limit(1).collect())
    if big:
        raise ValueError(f"column {big[0]['column']} has more than {most} values")
    rows = pairs.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values")).collect()
    pairs.unpersist()
    found = {r["column"]: list(r["values"]) for r in rows}
    return {c: found.get(c, []) for c in cols}


def apply_one_hot(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """E9 apply: ``<col>_<value>`` 0/1 flags for every fitted value."""
    adds = [F.coalesce((F.col(c) == v), F.lit(False)).cast("int").alias(f"{c}_{v}")
            for c, vs in values.items() for v in vs]
    return df.select("*", *adds)


def assemble(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    """Ordered feature vector."""
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="keep").transform(df)
