"""Scoring: additive tree ensembles, compiled to column expressions or walked as arrays; MLlib models.

``ensemble_score`` turns a small tree table (tree, node, feature, op, threshold,
yes, no, leaf) into nested ``CASE WHEN`` expressions, one per tree, and adds
them up; a large one is walked in Arrow batches. The tree table is a model, not
data: it is bounded by ``MAX_NODES`` before it is read on the driver.
"""

from __future__ import annotations

import operator
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from stayput import presets
from stayput.functions.columns import sigmoid
from stayput.session import ship

TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("threshold", T.StringType()),
    T.StructField("yes", T.IntegerType()),
    T.StructField("no", T.IntegerType()),
    T.StructField("leaf", T.DoubleType()),
])
MAX_NODES = 200_000
TREES_COMPILED, DEPTH_COMPILED = 20, 12
_COMPARE = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le,
            "=": operator.eq, "==": operator.eq, "!=": operator.ne, "<>": operator.ne}
_ORDERING = {">": "__gt__", "<": "__lt__", ">=": "__ge__", "<=": "__le__"}
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def worked_example_trees(spark: SparkSession | None = None) -> list[tuple]:
    """The worked-example ensemble as tree rows (``as_table`` makes a tree table of them)."""
    return list(presets.WORKED_EXAMPLE_TREES)


def as_table(spark: SparkSession, rows) -> DataFrame:
    """Tree rows -> a tree table DataFrame in ``TREE_SCHEMA``."""
    return spark.createDataFrame(list(rows), TREE_SCHEMA)


def _test(df: DataFrame, feature: str, op: str, threshold: str) -> Column:
    kind = df.schema[feature].dataType
    test = _compared(F.col(feature), isinstance(kind, _NUMERIC), op, threshold)
    # Spark orders NaN above every value; here it fails every test, as null does
    return test & ~F.isnan(feature) if isinstance(kind, (T.FloatType, T.DoubleType)) else test


def _compared(c: Column, numeric: bool, op: str, threshold: str) -> Column:
    if op in _ORDERING:
        return getattr(c, _ORDERING[op])(F.lit(float(threshold)))
    value = F.lit(float(threshold)) if numeric else F.lit(threshold)
    if op in ("=", "=="):
        return c == value
    if op in ("!=", "<>"):
        return c != value
    raise ValueError(f"unknown split operator {op!r}")


def _depth(nodes: dict[int, tuple]) -> int:
    """Levels of a tree, found level by level; a table whose nodes form a circle is an error."""
    level, depth = [0], 0
    while level := [c for n in level if nodes[n][0] is not None for c in nodes[n][3:5]]:
        depth += 1
        if depth > len(nodes):
            raise ValueError("the tree table has a circle")
    return depth


def _tree_expr(df: DataFrame, nodes: dict[int, tuple], node: int = 0) -> Column:
    feature, op, threshold, yes, no, leaf = nodes[node]
    if feature is None:
        return F.lit(float(leaf))
    # a null or NaN test value is not true -> the "no" branch
    return F.when(_test(df, feature, op, threshold),
                  _tree_expr(df, nodes, yes)) \
        .otherwise(_tree_expr(df, nodes, no))


def tree_rows(trees, most: int = MAX_NODES) -> list[tuple]:
    """The rows of a tree table (DataFrame, read after a size check), or rows as given. ``most`` bounds the model, not data."""
    if isinstance(trees, DataFrame):
        rows = [tuple(r) for r in trees.select(*TREE_SCHEMA.fieldNames()).limit(most + 1).collect()]
    else:
        rows = [tuple(r) for r in trees]
    if len(rows) > most:
        raise ValueError(f"ensemble has more than {most} nodes; raise the bound or score with the MLlib model")
    return rows


def compile_trees(df: DataFrame, trees) -> list[Column]:
    """One ``Column`` per tree, in tree order, from a tree table or its rows in ``TREE_SCHEMA`` order."""
    by_tree = _by_tree(tree_rows(trees))
    return [_tree_expr(df, by_tree[t]) for t in sorted(by_tree)]


def _by_tree(rows) -> dict[int, dict[int, tuple]]:
    by_tree: dict[int, dict[int, tuple]] = defaultdict(dict)
    for tree, node, *rest in rows:
        by_tree[tree][node] = tuple(rest)
    return by_tree


def ensemble_score(df: DataFrame, trees, out: str = "raw_score") -> DataFrame:
    """M3: raw score = sum over trees of the reached leaf value.

    Up to ``TREES_COMPILED`` trees become column expressions. More would pass the size of method that the JVM
    compiles, so they are walked as flat arrays, all rows of an Arrow batch at a time: linear in the trees. So are trees deeper
    than ``DEPTH_COMPILED``.
    """
    rows = tree_rows(trees)
    by_tree = _by_tree(rows)
    if len(by_tree) <= TREES_COMPILED and max(map(_depth, by_tree.values()), default=0) <= DEPTH_COMPILED:
        total = None
        for e in compile_trees(df, rows):
            total = e if total is None else total + e
        return df.withColumn(out, total)
    flat = FlatTrees(df, rows)
    if not flat.features:  # leaves alone
        return df.withColumn(out, F.lit(float(sum(flat.leaf[flat.roots]))))
    ship(df.sparkSession)

    @pandas_udf("double")
    def walk(cols: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for some in cols:
            yield pd.Series(flat.score(some if isinstance(some, tuple) else (some,)))     # one column comes alone

    return df.withColumn(out, walk(*[F.col(c) for c in flat.features]))


@dataclass
class TreeModel:
    """A saved ensemble: the rows of its tree table."""

    table: list[tuple]

    def rows(self) -> list[tuple]:
        return self.table


class FlatTrees:
    """All nodes in arrays. Each distinct test (feature, operator, value) is evaluated once per batch; a missing value (null or
    NaN) fails every test and so takes the "no" branch, as in the compiled form."""

    def __init__(self, df: DataFrame, rows):
        rows = sorted(rows, key=lambda r: r[:2])
        place = {(r[0], r[1]): i for i, r in enumerate(rows)}
        self.features = sorted({r[2] for r in rows if r[2] is not None})
        numeric = {f: isinstance(df.schema[f].dataType, _NUMERIC) for f in self.features}
        tests = sorted({(r[2], r[3], r[4]) for r in rows if r[2] is not None})
        at = {t: i for i, t in enumerate(tests)}
        self.tests = [(self.features.index(f), op, float(v) if numeric[f] or op in _ORDERING else v, numeric[f]) for f, op, v in tests]
        self.test = np.array([at[r[2], r[3], r[4]] if r[2] is not None else len(tests) for r in rows])
        self.yes = np.array([place[r[0], r[5]] if r[2] is not None else i for i, r in enumerate(rows)])
        self.no = np.array([place[r[0], r[6]] if r[2] is not None else i for i, r in enumerate(rows)])
        self.leaf = np.array([0.0 if r[7] is None else float(r[7]) for r in rows])
        self.roots = [place[t, 0] for t in sorted({r[0] for r in rows})]

    def score(self, cols) -> np.ndarray:
        n = len(cols[0]) if cols else 0
        met = np.zeros((n, len(self.tests) + 1), bool)
        for k, (f, op, value, numeric) in enumerate(self.tests):
            c = cols[f]
            x = c.astype(float).to_numpy() if numeric or op in _ORDERING else c.to_numpy(object)
            met[:, k] = c.notna().to_numpy() & _COMPARE[op](x, value)
        total, rows = np.zeros(n), np.arange(n)
        for root in self.roots:
            at = np.full(n, root)
            while True:
                to = np.where(met[rows, self.test[at]], self.yes[at], self.no[at])
                if (to == at).all():
                    break
                at = to
            total += self.leaf[at]
        return total


def weighted_copies(rows, weights) -> list[tuple]:
    """An ensemble of copies of ``rows``, the leaves of each scaled by its weight."""
    step = max(r[0] for r in rows) + 1
    return [(k * step + r[0], *r[1:7], None if r[7] is None else r[7] * w) for k, w in enumerate(weights) for r in rows]


def with_probability(df: DataFrame, raw: str = "raw_score", out: str = "probability") -> DataFrame:
    """M4: logistic link p = 1 / (1 + e^-F)."""
    return df.withColumn(out, sigmoid(raw))


def decide(p: str | Column, threshold: float = presets.DECISION_THRESHOLD,
           strict: bool = False) -> Column:
    """1 when p >= threshold (p > threshold when ``strict``)."""
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c > threshold if strict else c >= threshold, F.lit(1)).otherwise(F.lit(0))


def score_ensemble(df: DataFrame, trees, threshold: float = 0.5) -> DataFrame:
    """M3 -> M4 -> M5: adds raw_score, probability, prediction (0/1)."""
    out = with_probability(ensemble_score(df, trees))
    return out.withColumn("prediction", decide("probability", threshold))


def score_model(df: DataFrame, model, features_col: str = "features",
                labels: list[str] | None = None) -> DataFrame:
    """M1: apply a fitted model; keeps every input column (M6).

    The model is a boosted ensemble or a loaded ``TreeModel``, scored through its tree table from the feature columns, or an
    MLlib classifier on ``features_col``. Adds ``probability`` = P(class 1) and ``prediction`` (decoded through ``labels``
    when given, e.g. ["No", "Yes"]).
    """
    if hasattr(model, "rows"):
        scored = score_ensemble(df, model.rows()).drop("raw_score")
    else:
        scored = model.transform(df).withColumn("probability", vector_to_array("probability")[1]).drop("rawPrediction")
    if labels is not None:
        lut = F.array(*[F.lit(x) for x in labels])
        scored = scored.withColumn("prediction", F.element_at(lut, F.col("prediction").cast("int") + 1))
    else:
        scored = scored.withColumn("prediction", F.col("prediction").cast("int"))
    return scored.drop(features_col)
