"""Column-expression helpers shared by the operators.

All helpers return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_right_closed(c: str | Column, edges: Sequence[float],
                     labels: Sequence[int] | None = None, other: int = -1) -> Column:
    """Right-closed bins ``(e[i], e[i+1]] -> labels[i]``; outside or null -> ``other``.

    Unlike ``Bucketizer`` (left-closed), a value equal to an upper edge falls
    in the lower bin, as with ``pandas.cut``.
    """
    x = as_col(c)
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(other)).cast("int")


def bin_left_closed(c: str | Column, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """``x < cut_i -> label_i`` in order, else ``top`` (null falls to ``top``)."""
    x = as_col(c)
    expr = None
    for cut, lab in cuts:
        cond = x < F.lit(cut)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(top))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int, null -> 0 (a missing value never matches)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def ne_null_true(c: str | Column, value) -> Column:
    """``c != value`` with a null counting as "different" (pandas semantics)."""
    return ~as_col(c).eqNullSafe(F.lit(value))


def not_in_null_true(c: str | Column, values: Iterable) -> Column:
    """``c not in values`` with null -> True."""
    return F.coalesce(~as_col(c).isin(list(values)), F.lit(True))


def count_where(cols: Sequence[str | Column], pred: Callable[[Column], Column]) -> Column:
    """Number of columns for which ``pred`` holds (null predicate -> 0)."""
    parts = [flag(pred(as_col(c))) for c in cols]
    return reduce(lambda a, b: a + b, parts).cast("int") if parts else F.lit(0)


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Null-skipping row sum (all-null -> 0)."""
    parts = [F.coalesce(as_col(c), F.lit(0)) for c in cols]
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0)


def map_lookup(c: str | Column, mapping: Mapping) -> Column:
    """Lookup in a literal map; unmapped or null key -> null."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    key = as_col(c)
    return F.when(key.isNull(), F.lit(None)).otherwise(F.try_element_at(m, key))


def round_half_even(c: str | Column, scale: int) -> Column:
    """NumPy ``np.round(x, scale)``: ``rint(x * 10^s) / 10^s``."""
    k = float(10 ** scale)
    return F.rint(as_col(c) * F.lit(k)) / F.lit(k)


def sigmoid(c: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_col(c)))


def nan_to_null(c: str | Column) -> Column:
    """NaN and null are one "missing" value."""
    return F.nanvl(as_col(c), F.lit(None).cast("double"))
