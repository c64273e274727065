"""Filter interaction audit: what each filter removes in every order, read from one contingency table per part.

Each document fails or passes five filters, so a part is a 2x2x2x2x2 tensor of counts (index 0: pass, 1: fail on each axis).
Every number of the report is a contraction of that tensor: on each axis a vector picks pass (1, 0), fail (0, 1) or all (1, 1).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayput.llm.common import SPACES, staged, text_or_empty

FILTERS = "ABCDE"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SIGNS = 200, 50, 3, "[#$%&*|]"
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> list[Column]:
    """Booleans of filters A to D, which read nothing but the text: few words, repeated words, capitals, signs."""
    words = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    n = F.size(words).cast("long")
    distinct = F.size(F.array_distinct(words)).cast("long")
    capitals = (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long")
    return [n < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * capitals > UPPER_PERCENT * F.length(text).cast("long"),
            text.rlike(SIGNS)]


def contingency(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and set of failed filters (bit 0: A, bit 4: E), at most 32 rows a part.

    A document fails E if any row of the table with an equal text has a smaller id; a null id is neither smaller nor larger
    than another, so it does not fail. A null text is the empty text, a null part the part of the empty string. Repeated rows count each.
    A document is good (toxic) if any row of ``labels`` with its id says so; ids that are null have no label. Empty tables give no rows.

    Rows carry a digest of their text instead of it. They are counted before each shuffle, so a text that fills a third of the
    table is a few rows, and the smallest id of a text is found by a grouping, not by reading its copies together.
    """
    body = F.col("t")
    fails = text_failures(body)
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text_or_empty(text).alias("t"))
    rows = rows.select("i", "part", mask.alias("mask"), F.unhex(F.sha2("t", 256)).alias("h"))
    rows = rows.groupBy("i", "h", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = rows.where(F.col("i").isNotNull()).join(said, "i", "left")
    unnamed = rows.where(F.col("i").isNull()).select("*", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    rows = named.unionByName(unnamed).select("i", "h", "part", "mask", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    # of one text, part and label: all rows, and the rows of its smallest id
    few = rows.groupBy("h", "part", "mask", "good", "toxic", "i").agg(F.sum("n").alias("n")) \
        .groupBy("h", "part", "mask", "good", "toxic").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("i").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
            F.min(F.when(F.col("i").isNotNull(), F.struct("i", "n"))).alias("least"))
    few = staged(few, "texts")
    first = few.groupBy("h").agg(F.min("least.i").alias("first"), F.count(F.lit(1)).alias("kinds"))
    few = few.join(first, "h")
    passing = F.col("unnamed") + F.when(F.col("least.i") == F.col("first"), F.col("least.n")).otherwise(0)
    cells = few.select("part", "mask", "good", "toxic", passing.alias("passing"), (F.col("n") - passing).alias("failing"))
    both = cells.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), F.col("passing").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), F.col("failing").alias("n")))).alias("c"))
    n = F.col("c.n")
    return both.where(n > 0).groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def _selectors() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The (order, step) pairs, and for every number of the report its vectors as an array (pair, axis, pass or fail)."""
    pairs, picks = [], {"kept": [], "removed": [], "failing": [], "unique": []}
    for order in itertools.permutations(range(len(FILTERS))):
        name = "".join(FILTERS[f] for f in order)
        for step, f in enumerate(order):
            pairs.append((name, step + 1))
            before, until = set(order[:step]), set(order[:step + 1])
            axes = range(len(FILTERS))
            picks["kept"].append([PASS if a in until else ALL for a in axes])
            picks["removed"].append([FAIL if a == f else PASS if a in before else ALL for a in axes])
            picks["failing"].append([FAIL if a == f else ALL for a in axes])
            picks["unique"].append([FAIL if a == f else PASS for a in axes])
    return pairs, {k: np.array(v, np.int64) for k, v in picks.items()}


def _contracted(tensor: np.ndarray, picks: np.ndarray) -> np.ndarray:
    return np.einsum("abcde,na,nb,nc,nd,ne->n", tensor, *(picks[:, a] for a in range(len(FILTERS))), optimize=True)


def _report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pairs, picks = _selectors()
    last = np.array([FILTERS.index(name[step - 1]) for name, step in pairs])
    for frame in frames:
        for row in frame.itertuples(index=False):
            n, good, toxic = (np.array(x, np.int64).reshape((2,) * len(FILTERS)) for x in (row.n, row.good, row.toxic))
            removed = _contracted(n, picks["removed"])
            whole = np.zeros(len(FILTERS), np.int64)
            np.add.at(whole, last, removed)
            yield pd.DataFrame({
                "part": row.part, "filter_order": [p[0] for p in pairs], "step": np.array([p[1] for p in pairs], np.int32),
                "kept": _contracted(n, picks["kept"]), "removed": removed, "redundant": _contracted(n, picks["failing"]) - removed,
                "unique_fails": _contracted(n, picks["unique"]), "good_lost": _contracted(good, picks["removed"]),
                "toxic_lost": _contracted(toxic, picks["removed"]), "shapley": whole[last]})


def interactions(cells: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included, from the cells of ``contingency``; no cells give no rows.

    A part is one row of three arrays with 32 numbers, whatever its documents; parts are dealt over the tasks.
    """
    at = [F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)) for c in ("n", "good", "toxic")
          for m in (sum((place >> (len(FILTERS) - 1 - a) & 1) << a for a in range(len(FILTERS))) for place in range(1 << len(FILTERS)))]
    size = 1 << len(FILTERS)
    wide = cells.groupBy("part").agg(*[F.array(*at[k * size:(k + 1) * size]).alias(c) for k, c in enumerate(("n", "good", "toxic"))])
    return wide.mapInPandas(lambda frames: _report(frames), SCHEMA)


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return interactions(contingency(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
f AS (SELECT part, doc_id, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
    100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(first_id < doc_id, false)] AS fails FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
k AS (SELECT part, filter_order, step, n, good, toxic, fails[instr('ABCDE', filter_order[step])] AS here,
    len(list_filter(range(1, step), lambda i: fails[instr('ABCDE', filter_order[i])])) > 0 AS before, len(list_filter(fails, lambda b: b)) AS all_fails
    FROM c, s),
r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    CAST(coalesce(sum(n) FILTER (NOT before AND NOT here), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (here AND NOT before), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (here AND before), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (here AND all_fails = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (here AND NOT before), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (here AND NOT before), 0) AS BIGINT) AS toxic_lost
    FROM k GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM r
"""
